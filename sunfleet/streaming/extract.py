"""Daily extract of newly arrived raw files.

Each run takes the files that arrived since the last one, keeps the maker's devices, appends the
rows to day partitions and stops. Progress lives in the stream's checkpoint, so a rerun after a
failure neither loses nor repeats a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.cleaning import DEVICE_PREFIX
from ..plans import incremental


def new_rows(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet") -> DataFrame:
    """Streaming frame over the parquet files of a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def extract_days(
    rows: DataFrame, out: str, checkpoint: str, prefix: str = DEVICE_PREFIX, time: str = "createtime"
) -> None:
    """Append all available rows of the maker's devices to ``out``, partitioned by ``ds``."""
    stamped = rows.filter(F.col("sn").startswith(prefix)).withColumn("ds", F.to_date(time))
    query = (
        stamped.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ds")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def keep_daily_state(rows: DataFrame, root: str, checkpoint: str) -> None:
    """Bring the daily state below ``root`` up to date with all available files, one batch of them after the other.

    A batch that was interrupted comes again under the same number and replaces itself.
    """

    def absorb(batch: DataFrame, number: int) -> None:
        incremental.absorb(batch.sparkSession, root, batch, f"stream-{number:09d}")

    query = rows.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
