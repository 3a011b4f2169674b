"""Session helpers that every part shares."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, besides what they have installed."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def stored(df: DataFrame, all_tasks: bool = False) -> DataFrame:
    """df written to the folder of spark.checkpoint.dir and read again, for rows that must not be made twice.

    With all_tasks, adaptive execution doesn't join small shuffle partitions while it is written.

    Where none is set, a local master gets a local folder, as in tests, and others an error.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="rollcall-")
    path = f"{folder.rstrip('/')}/stored-{uuid.uuid4().hex}"
    _stored.add(path)
    before = spark.conf.get(_COALESCE, None)
    if all_tasks:
        spark.conf.set(_COALESCE, "false")
    try:
        df.write.parquet(path)
    finally:
        if all_tasks:
            spark.conf.unset(_COALESCE) if before is None else spark.conf.set(_COALESCE, before)
    return spark.read.schema(df.schema).parquet(path)


_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
#: Folders that stored() made and nobody deleted yet.
_stored: set[str] = set()


def clean(spark: SparkSession) -> None:
    """Delete every table that stored() made in this driver; for after the results are written, as plans read them lazily."""
    while _stored:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_MADE: dict[str, object] = {}


def once_a_worker(factory: Callable[[], object]) -> Callable[[], object]:
    """A function that makes factory's object once in each Python worker; factories are told apart by their content."""
    key = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def made() -> object:
        if key not in _MADE:
            _MADE[key] = factory()
        return _MADE[key]

    return made
