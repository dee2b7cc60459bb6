"""Session settings the package relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on the time zone only; the others steer physical execution.
# hugeMethodLimit: wide telemetry projections compile to methods above 8000 bytes of bytecode,
# which the JVM never JIT-compiles; below that limit Spark splits the work into smaller methods.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # the threshold is compared with compressed files; this makes it bound their size in memory
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Setting that names the current run.
RUN = "sunfleet.run"


def build_session(app_name: str = "sunfleet", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the settings above; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sunfleet-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def start_run(spark: SparkSession, name: str | None = None) -> str:
    """From now on intermediates of this session go to a folder of their own, which ``cleanup`` removes; returns the run's name."""
    name = name or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
        raise ValueError(f"a run's name has letters, digits, - and _ only: {name!r}")
    spark.conf.set(RUN, name)
    return name


def cleanup(spark: SparkSession, run: str) -> None:
    """Remove the intermediates of a run, once nothing that reads them is needed any more."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run):
        raise ValueError(f"no run: {run!r}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_folder(spark), f"run-{run}"))
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    if spark.conf.get(RUN, None) == run:
        spark.conf.unset(RUN)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, inside the folder of the current run if there is one."""
    run = spark.conf.get(RUN, None)
    return os.path.join(shared_folder(spark), *([f"run-{run}"] if run else []), f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that later stages, and reruns after lost executors, start from columnar
    files instead of the whole plan. Later readers still prune columns and push filters.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, label: str = "devices") -> DataFrame:
    """A per-device table as files of known size.

    Joined to the readings, the planner then broadcasts it if the files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and the readings stay where they are; a larger table
    gets a sort-merge join with skew handling. Without the files its size is unknown when the
    join is planned, and the readings would be shuffled in any case.
    """
    return written(df, label)
