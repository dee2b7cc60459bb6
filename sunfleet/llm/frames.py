"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunfleet.session import written

#: A written table is broadcast up to this many rows and bytes; beyond, Spark joins by sort and merge.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20


#: Rows that travel to a Python worker at once; texts may be long.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Let the session send texts to Python workers in small batches, so that a worker's memory stays bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small(table: DataFrame) -> bool:
    """Whether a written table is proven small enough to be sent to every executor."""
    size = [F.coalesce(F.sum(_bytes(c, kind)), F.lit(0)) for c, kind in table.dtypes]
    row = table.agg(F.count(F.lit(1)).alias("n"), sum(size[1:], size[0]).alias("bytes")).first()
    return row["n"] <= BROADCAST_ROWS and row["bytes"] <= BROADCAST_BYTES


def _bytes(name: str, kind: str) -> Column:
    """Bytes of a value in memory, about."""
    if kind.startswith(("array", "map")):
        width = 8 * max(1, kind.count(":"))
        return F.size(name).cast("long") * width + 32
    if kind in ("string", "binary"):
        return F.octet_length(name).cast("long") + 16
    return F.lit(8)


def joined(big: DataFrame, table: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join a written table: broadcast if its size is checked to be small, else as Spark plans it."""
    return big.join(F.broadcast(table) if small(table) else table, on, how)


def identified(docs: DataFrame, id_column: str) -> tuple[DataFrame, str]:
    """``docs`` and a column of unique long ids in the order of ``id_column``: that column itself if it is unique and never null.

    Otherwise the rows are numbered in order of id (null last) and of all other columns, and written, so the numbers stay.
    """
    counts = docs.groupBy(F.col(id_column).cast("long").alias("id")).count().filter("count > 1 or id is null").limit(1).count()
    number = fresh(docs, "row_id")
    if not counts:
        return docs.withColumn(number, F.col(id_column).cast("long")), number
    key = F.col(id_column).cast("long")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    ordered = docs.repartitionByRange(key.asc_nulls_last(), whole).sortWithinPartitions(key.asc_nulls_last(), whole)
    return written(ordered.withColumn(number, F.monotonically_increasing_id()), "rows"), number
