"""Model registry in a folder: ``<root>/<out_days>_<time_range>/<name>_<stamp>``, made visible by a log of commits.

A version is written first and committed last: one small file ``<root>/log/<number>.json``, created only if that number is free. Of two runs that
save at once one takes the next number and the other the one after it; a reader sees a version whole or not at all.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fleet import latest_version
from ..sources.readers import read_manifest
from ..sources.writers import write_manifest
from . import boosting

COMMITS = "version bigint, path string, modified string, kind string"
LOG = "log"
TREES, PIPELINE = "trees", "pipeline"


def model_path(root: str, name: str, out_days: int, time_range: int, stamp: str) -> str:
    return os.path.join(root, f"{out_days}_{time_range}", f"{name}_{stamp}")


def root_of(path: str) -> str:
    """Registry folder of a version's path."""
    return os.path.dirname(os.path.dirname(path))


def write_model(spark: SparkSession, model: PipelineModel | boosting.TreeModel, path: str, features: Sequence[str]) -> str:
    """Model and feature manifest of a version that is not visible yet; returns the kind of model."""
    write_manifest(spark, features, os.path.join(path, "features"))
    if isinstance(model, boosting.TreeModel):
        boosting.save(model, spark, path)
        return TREES
    model.write().overwrite().save(os.path.join(path, "model"))
    return PIPELINE


def _created(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file unless it exists; the store decides who is first."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        stream = store.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(content.encode()))
    stream.close()
    return True


def commit(spark: SparkSession, path: str, stamp: str, kind: str) -> int:
    """Make a written version visible under the next free number."""
    root = root_of(path)
    # one number is collected
    version = (registry(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    while not _created(spark, os.path.join(root, LOG, f"{version:012d}.json"), json.dumps({"version": version, "path": path, "modified": stamp, "kind": kind})):
        version += 1
    return version


def save_model(spark: SparkSession, model: PipelineModel | boosting.TreeModel, path: str, features: Sequence[str], stamp: str) -> str:
    """Write a version and commit it."""
    commit(spark, path, stamp, write_model(spark, model, path, features))
    return path


def registry(spark: SparkSession, root: str) -> DataFrame:
    """(version, path, modified, kind) of every committed version, none if nothing was saved yet; a file still being written is no commit."""
    try:
        return spark.read.schema(COMMITS).json(os.path.join(root, LOG)).filter("version is not null and path is not null")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def load_model(spark: SparkSession, path: str, kind: str = PIPELINE) -> tuple[PipelineModel | boosting.StoredTrees, list[str]]:
    features = read_manifest(spark, os.path.join(path, "features"))
    if kind == TREES:
        return boosting.load(spark, path, features), features
    return PipelineModel.load(os.path.join(path, "model")), features


def stage_path(spark: SparkSession, path: str, kind: str) -> str:
    """Folder of the pipeline stage whose class name ends in ``kind``, from the stage metadata."""
    stages = os.path.join(path, "model", "stages")
    listed = (
        spark.read.text(os.path.join(stages, "*", "metadata"))
        .select("value", F.regexp_extract(F.col("_metadata.file_path"), "/stages/([^/]+)/", 1).alias("stage"))
        .filter(F.get_json_object("value", "$.class").endswith(kind))
        .select("stage")
        .first()
    )
    if listed is None:
        raise FileNotFoundError(f"no {kind} stage in {path}")
    return os.path.join(stages, listed["stage"])


def load_latest(spark: SparkSession, root: str) -> tuple[PipelineModel | boosting.StoredTrees, list[str], str]:
    """Newest version (by stamp, then by commit) with its manifest. One row is collected."""
    commits = registry(spark, root)
    stamped = commits.withColumn("modified", F.concat_ws("#", "modified", F.lpad(F.col("version").cast("string"), 12, "0")))
    row = latest_version(stamped).join(commits.select("path", "version", "kind"), "path").orderBy(F.desc("version")).first()
    if row is None:
        raise FileNotFoundError(f"no model below {root}")
    model, features = load_model(spark, row["path"], row["kind"])
    return model, features, row["path"]
