"""Registry of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sunfleet.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 9


# Short decimals often lie exactly between two rounded values, where two engines may differ by one
# unit; where that happens, both sides add this amount before they round to 6 digits.
TIE_SHIFT = 3.7e-8


def tidy(df: DataFrame, digits: int = DIGITS, shift: float = 0.0) -> DataFrame:
    """Comparable column types: rounded doubles, bigint, text for days and times."""
    out = []
    for name, kind in df.dtypes:
        c = f"`{name}`"
        if kind in ("double", "float"):
            c = f"round(cast({c} as double) + {shift!r}D, {digits}) + 0.0D"
        elif kind in ("int", "smallint", "tinyint", "boolean", "bigint"):
            c = f"cast({c} as bigint)"
        elif kind == "date":
            c = f"date_format({c}, 'yyyy-MM-dd')"
        elif kind.startswith("timestamp"):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        out.append(f"{c} as `{name}`")
    return df.selectExpr(*out)


def query(name: str, oracle: str | None = None, digits: int = DIGITS, shift: float = 0.0):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``oracle`` is its SQL, if SQL can say it."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(tune(spark), sf_dir), digits, shift)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
