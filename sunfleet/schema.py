"""Column lists and types of the telemetry fact table."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = range(1, 7)  # DC strings kept by the cleaner
PHASES = range(1, 4)

DEVICE = "sn"
TIME = "createtime"
ERROR = "errorcode"
TEXT_COLUMNS = (DEVICE, TIME, ERROR)

IPV = [f"ipv{i}" for i in STRINGS]
VPV = [f"vpv{i}" for i in STRINGS]
VAC = [f"vac{i}" for i in PHASES]
IAC = [f"iac{i}" for i in PHASES]
POWER = ["outputpowerratio", "activepower", "reactivepower", "inspectingpower"]

# The 34 model-relevant columns, in the order of the cleaned table.
CORE_COLUMNS = [
    "temperature", *VPV, *IPV, *VAC, *IAC, "fac1", "fac2",
    "pac", "eday", "etotal", "ttotal", "outputpowerratio", "activepower", "reactivepower",
    "inspectingpower", "powerfactor", "createtime", "sn", "errorcode", "switchstatus",
]
CORE_NUMERIC = [c for c in CORE_COLUMNS if c not in TEXT_COLUMNS]

# The 82 columns a job reads from the raw table unless it is given its own list.
CONFIGURED_COLUMNS = (
    ["temperature"]
    + [f"vpv{i}" for i in range(1, 31)]
    + [f"ipv{i}" for i in range(1, 31)]
    + VAC + IAC + ["fac1", "fac2", "pac", "eday", "etotal", *POWER, "powerfactor"]
    + ["createtime", "sn", "ttotal", "switchstatus", "errorcode"]
)

# Metrics of the raw fact table, before the cleaner narrows them.
RAW_NUMERIC = (
    ["temperature"]
    + [f"vpv{i}" for i in range(1, 31)]
    + [f"ipv{i}" for i in range(1, 31)]
    + VAC + IAC + [f"fac{i}" for i in PHASES]
    + ["pac", "eday", "etotal", "ttotal", *POWER, "powerfactor", "switchstatus"]
)


def _fields(numeric, text, time_type):
    return T.StructType(
        [T.StructField(DEVICE, T.StringType()), T.StructField(TIME, time_type)]
        + [T.StructField(c, T.StringType()) for c in text]
        + [T.StructField(c, T.DoubleType()) for c in numeric]
    )


CORE_SCHEMA = _fields(CORE_NUMERIC, [ERROR], T.TimestampType())
RAW_SCHEMA = _fields(RAW_NUMERIC, [ERROR], T.StringType())
LABEL_SCHEMA = T.StructType(
    [T.StructField(DEVICE, T.StringType()), T.StructField("error_type", T.IntegerType())]
)
FETCH_SCHEMA = T.StructType(
    [T.StructField(DEVICE, T.StringType()), T.StructField("return_date", T.StringType())]
)
