"""Readers and writers: tables, JSON documents, pictures, label and skip files; upserts by a versioned swap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from ..operators.ingest import new_rows, replaced
from ..session import stored

# -- readers ---------------------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table with a declared schema; only the columns a plan uses are read."""
    return spark.read.schema(schema).parquet(path)


def read_document(spark: SparkSession, path: str, schema: DataType, strict: bool = True) -> DataFrame:
    """(video_id, document) of a JSON file that maps ids to objects.

    strict: text that isn't such a map raises when it is read. Otherwise it counts as an empty map.
    """
    text = spark.read.text(path, wholetext=True)
    kind = f"map<string,{schema.valueType.simpleString()}>"
    whole = F.from_json("value", kind, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    return text.select(F.explode(whole).alias("video_id", "document"))


def screenshots_of(documents: DataFrame) -> DataFrame:
    """(video_id, video_timestamp_sec, players, upload_date) of screenshot documents: one row a screenshot."""
    shots = documents.select("video_id", F.col("document.upload_date").alias("upload_date"), F.explode("document.screenshots").alias("second", "players"))
    return shots.select("video_id", F.col("second").try_cast("int").alias("video_timestamp_sec"), "players", "upload_date")


def metadata_of(documents: DataFrame) -> DataFrame:
    """The six metadata fields of screenshot documents."""
    fields = ("title", "upload_date", "duration", "uploader", "tags", "thumbnail")
    return documents.select("video_id", *[F.col(f"document.{f}").alias(f) for f in fields])


def read_pictures(spark: SparkSession, folder: str, recursive: bool = True, content: bool = True) -> DataFrame:
    """(path, length, content) of .png files; without content only names are listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.png")
    files = reader.load(folder)
    return files.select("path", "length", *(["content"] if content else []))


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, line) of label text files."""
    lines = spark.read.option("pathGlobFilter", "*.txt").text(folder).withColumn("path", F.input_file_name())
    return lines.select(F.regexp_extract("path", r"([^/]*)\.txt$", 1).alias("stem"), F.col("value").alias("line"))


def channels(spark: SparkSession, urls: list[str]) -> DataFrame:
    """A literal list of channels."""
    return spark.createDataFrame([(u,) for u in urls], "url string")


# -- writers ---------------------------------------------------------------------------------------


class Table:
    """A Parquet table in versions: `path/_current-<n>` lists the folders `path/v=<m>` that hold version n's rows.

    A change writes one new folder and becomes current by one small rename, so readers see the old table or the
    new one, a failed job leaves the old one, and older versions are backups. Inserted rows are appended: known
    rows aren't written again until MOST_PARTS folders have come together. A plan may read the table that it
    replaces.
    """

    MOST_PARTS = 64

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The version that holds; 0 is the empty table."""
        marks = self._fs.globStatus(self._path(f"{self.path}/_current-*"))
        return max((int(m.getPath().getName().rpartition("-")[2]) for m in marks or []), default=0)

    def parts(self, version: int | None = None) -> list[str]:
        """Names of the folders that hold a version."""
        n = self.version() if version is None else version
        if not n:
            return []
        file = self._fs.open(self._path(f"{self.path}/_current-{n}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8").split()
        finally:
            file.close()

    def read(self, version: int | None = None) -> DataFrame:
        parts = self.parts(version)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], self.schema)

    def stage(self, rows: DataFrame, append: bool = False) -> tuple[int, list[str]]:
        """rows written as the next version's folder, with that version's number and folders; not current yet."""
        n, parts = self.version() + 1, self.parts() if append else []
        if len(parts) >= self.MOST_PARTS:
            rows, parts = self.read().unionByName(rows.select(self.schema.names)), []
        rows.select(self.schema.names).write.mode("overwrite").parquet(f"{self.path}/v={n}")
        return n, [*parts, f"v={n}"]

    def make_current(self, n: int, parts: list[str]) -> None:
        new, mark = self._path(f"{self.path}/_new-{n}"), self._path(f"{self.path}/_current-{n}")
        out = self._fs.create(new, True)
        out.write(bytearray("\n".join(parts).encode()))
        out.close()
        if self._fs.exists(mark) or not self._fs.rename(new, mark):
            raise RuntimeError(f"version {n} of {self.path} was made by another writer")

    def overwrite(self, rows: DataFrame) -> int:
        """rows as the whole table."""
        staged = self.stage(rows)
        self.make_current(*staged)
        return staged[0]

    def append(self, rows: DataFrame) -> int:
        """rows besides those there are."""
        staged = self.stage(rows, append=True)
        self.make_current(*staged)
        return staged[0]

    def insert_or_ignore(self, rows: DataFrame, keys: list[str]) -> int:
        """Rows of new keys are appended; the first row of a key wins."""
        return self.append(new_rows(rows.select(self.schema.names), self.read(), keys))

    def insert_or_replace(self, rows: DataFrame, keys: list[str]) -> int:
        """Rows of known keys are replaced, others added."""
        return self.overwrite(replaced(self.read(), rows, keys))


class PartitionedTable:
    """A Parquet table in partitions by a hash of its key. A replacement reads and writes the partitions of its keys only.

    Spark's dynamic partition overwrite stages new files and puts each partition in place when the job commits, so a
    failed job leaves the old rows, and one that runs again gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], partitions: int = 256):
        self.spark, self.path, self.schema, self.keys, self.partitions = spark, path.rstrip("/"), schema, keys, partitions
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.schema.names).withColumn("_part", F.pmod(F.xxhash64(*self.keys), F.lit(self.partitions)).cast("int"))

    def _rows(self) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField("_part", IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path) if self._fs.exists(self._path) else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._rows().select(self.schema.names)

    def insert_or_replace(self, rows: DataFrame, keys: list[str] | None = None) -> int:
        """Rows of known keys are replaced, others added; gives the number of partitions written."""
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"the table's key is {self.keys}")
        new = stored(self._dealt(rows))
        touched = [r._part for r in new.select("_part").distinct().collect()]  # `partitions` at most
        old = self._rows().where(F.col("_part").isin(touched))
        merged = replaced(old, new, [*self.keys, "_part"]).repartition("_part")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(self.path)
        return len(touched)


def write_together(changes: list[tuple[Table, DataFrame]], append: bool = False) -> None:
    """Several tables in one batch: all versions are written before any becomes current; a failure undoes those that did."""
    written = []
    staged = [(table, *table.stage(rows, append)) for table, rows in changes]
    try:
        for table, n, parts in staged:
            table.make_current(n, parts)
            written.append((table, n))
    except Exception:
        for table, n in written:
            table._fs.delete(table._path(f"{table.path}/_current-{n}"), False)
        raise


def document_lines(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(value): one JSON object a line, {key: value}."""
    return rows.select(F.to_json(F.create_map(F.col(key), F.col(value))).alias("value"))


def write_document(rows: DataFrame, key: str, value: str, path: str) -> None:
    """A JSON document as text lines, one entry a line and in order of the key; a single document is a concern of small exports."""
    rows.orderBy(key).transform(lambda d: document_lines(d, key, value)).write.mode("overwrite").text(path)


def write_skip_list(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


#: What each serving table is looked up by.
LOOKUPS = {"player_index": "player_name", "battle_matches": "battle_id", "map_index": "map_name", "ocr_index": "ocr_name"}
#: Bytes of a row group of a serving table: what a lookup reads at least.
LOOKUP_BYTES = 4 << 20


def write_serving_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as Parquet. Those that are looked up by a key are sorted by it over all files, in small row groups with
    Bloom filters of the key, so a lookup of a key reads the few row groups that hold it."""
    for name, rows in tables.items():
        key = LOOKUPS.get(name)
        if key is None:
            rows.write.mode("overwrite").parquet(f"{folder}/{name}")
            continue
        others = [c for c in rows.columns if c != key]
        laid = rows.repartitionByRange(key, *others).sortWithinPartitions(key, *others)
        laid.write.mode("overwrite").option("parquet.block.size", LOOKUP_BYTES).option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(f"{folder}/{name}")


def read_serving_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def sorted_map(column: Column) -> Column:
    """A map with its keys in order, for stable text."""
    return F.map_from_entries(F.array_sort(F.map_entries(column)))
