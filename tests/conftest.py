import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from sunfleet.session import build_session

    session = build_session(
        "tests", "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def core_row():
    """One healthy reading of the core columns; override what a test is about."""
    from sunfleet.schema import CORE_COLUMNS

    def build(**values):
        row = {c: 1.0 for c in CORE_COLUMNS}
        row.update(
            {
                "sn": "TP10KBT000B000000001", "createtime": "2024-01-10 12:00:00", "errorcode": "0",
                "switchstatus": 1.0, "powerfactor": 0.5, "reactivepower": 10.0,
                **{f"vpv{i}": 600.0 for i in range(1, 7)}, **{f"vac{i}": 220.0 for i in range(1, 4)},
            }
        )
        row.update(values)
        return row

    return build


@pytest.fixture()
def core_frame(spark, core_row):
    from pyspark.sql import types as T

    from sunfleet.schema import CORE_COLUMNS, TEXT_COLUMNS

    schema = T.StructType(
        [
            T.StructField(c, T.StringType() if c in TEXT_COLUMNS else T.DoubleType())
            for c in CORE_COLUMNS
        ]
    )

    def build(*rows):
        data = [tuple(core_row(**r)[c] for c in CORE_COLUMNS) for r in rows]
        return spark.createDataFrame(data, schema)

    return build
