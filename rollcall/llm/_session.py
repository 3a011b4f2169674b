"""What the operators take from the session: scratch tables in the shared folder, sizes and batch limits."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from rollcall.session import importable

#: Rows of an Arrow batch; with texts of a few KB a batch is a few MB.
BATCH_ROWS = 512
#: Stored bytes below which a table of few files is dealt out.
SPREAD_BYTES = 32 << 20
#: Bytes of an Arrow batch, about; fewer rows where they are long.
BATCH_BYTES = 4 << 20
#: Of the Python workers: arrays of 4 MB and more go back to the system when freed, as do 16 MB free at the heap's end;
#: glibc would raise both limits by itself, and Arrow's own pools keep what they once had.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20)}
#: Folders of the tables that keep() made and nobody deleted yet.
_made: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, so that a worker's memory doesn't follow the number of rows, and what workers keep; let them import this."""
    importable(spark)
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch(spark: SparkSession) -> str:
    """The shared checkpoint folder; where none is set, a local master gets a local one, as in tests, and others an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="rollcall-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def keep(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: lineage ends, lost executors lose nothing.

    The table stays until drop() or clean(), as plans that read it may run at any time.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession) -> str:
    """A path of its own in the shared folder; clean() deletes what is written there."""
    path = f"{scratch(spark).rstrip('/')}/rollcall-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def clean(spark: SparkSession) -> None:
    """Delete every table that this driver kept; for after the results are written."""
    while _made:
        _delete(spark, _made.pop())


def drop(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables that keep() made, once no later plan reads them."""
    for df in frames:
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/rollcall-" in file:
                _delete(spark, file)


def unused(df: DataFrame, name: str) -> str:
    """A column name made of name that df doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread(df: DataFrame) -> DataFrame:
    """A table of a few small files with its rows dealt to all cores, as one row group would be one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores and stored_bytes(df) < SPREAD_BYTES else df


def stored_bytes(df: DataFrame) -> int:
    """The size of the files that df scans; where it reads more than one table, or none, the rows' sizes are summed.

    Catalyst multiplies the sizes of joined tables, so its estimate of a join tells nothing of the rows.
    """
    from pyspark.sql import functions as F

    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = int(leaves.apply(0).stats().sizeInBytes()) if leaves.size() == 1 else 1 << 60
    if size >= 1 << 60:
        size = df.agg(F.sum(F.coalesce(F.length(F.to_json(F.struct("*"))), F.lit(0)))).first()[0] or 0
    return size


def buckets(df: DataFrame, each: int, least: int) -> int:
    """How many buckets hold `each` bytes of the stored input."""
    return max(least, math.ceil(stored_bytes(df) / each))
