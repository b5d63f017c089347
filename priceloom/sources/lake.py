"""The lake: Parquet partitioned by source and day of collection; idempotent writes, discovery, pruned scans and compaction."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priceloom.functions.text import path_segment
from priceloom.operators.quality import latest_by
from priceloom.schemas import RECORD

PARTS = ["source_part", "year", "month", "day"]


@dataclass(frozen=True)
class Partitions:
    """Which partitions to read: a source, and days from ``start`` to ``end``, both included."""

    source: str | None = None
    start: date | None = None
    end: date | None = None

    def __post_init__(self):
        if self.start and self.end and self.start > self.end:
            raise ValueError("start is after end")

    def apply(self, df: DataFrame) -> DataFrame:
        """Predicates on partition columns only, so that they prune directories."""
        if self.source is not None:
            df = df.filter(F.col("source_part") == path_segment(F.lit(self.source)))
        day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
        if self.start:
            df = df.filter((F.col("year").cast("int") >= self.start.year) & (day >= F.lit(self.start)))
        if self.end:
            df = df.filter((F.col("year").cast("int") <= self.end.year) & (day <= F.lit(self.end)))
        return df


def layer_schema(schema: T.StructType = RECORD) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(p, T.StringType()) for p in PARTS]])


def with_partitions(rows: DataFrame) -> DataFrame:
    at = F.col("collected_at")
    return rows.withColumns({"source_part": path_segment(F.col("source")), "year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")})


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _files(spark, path)
    return store.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order of name."""
    store, p = _files(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(p))


def put(spark: SparkSession, path: str, content: bytes) -> None:
    store, p = _files(spark, path)
    out = store.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def get(spark: SparkSession, path: str) -> bytes:
    """A small object as a whole; data files are read as frames."""
    store, p = _files(spark, path)
    if not store.exists(p):
        raise FileNotFoundError(path)
    lines = store.open(p)
    try:
        return bytes(lines.readAllBytes())
    finally:
        lines.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Whether there was something to delete."""
    store, p = _files(spark, path)
    return store.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to a place that is not taken; the folders above it are made."""
    store, p = _files(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(to)
    store.mkdirs(new.getParent())
    if store.exists(new) or not store.rename(p, new):
        raise OSError(f"{path} was not moved to {to}")


def stored_schema(spark: SparkSession, path: str, dirs: list[str] | None = None) -> T.StructType:
    """The columns of all files of the lake, or of some of its partitions, merged; partition columns are text."""
    found = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*(dirs or [path])).schema
    return layer_schema(T.StructType([f for f in found.fields if f.name not in PARTS]))


def scan(spark: SparkSession, path: str, where: Partitions = Partitions(), columns: list[str] | None = None, schema: T.StructType = RECORD) -> DataFrame:
    """A lazy, pruned and projected scan; without data an empty frame of the same schema."""
    full = layer_schema(schema)
    df = spark.read.schema(full).parquet(path) if exists(spark, path) else spark.createDataFrame([], full)
    df = where.apply(df)
    return df.select(*columns) if columns else df


def discover(spark: SparkSession, path: str, where: Partitions = Partitions()) -> DataFrame:
    """Partitions in order, each with its number of files; only partition columns and file names are read."""
    if not exists(spark, path):
        return spark.createDataFrame([], "source_part string, year string, month string, day string, file_count long")
    df = where.apply(spark.read.schema(layer_schema()).parquet(path)).select(*PARTS, F.col("_metadata.file_path").alias("f"))
    return df.groupBy(*PARTS).agg(F.countDistinct("f").alias("file_count")).orderBy(*PARTS)


def _place(rows: DataFrame, path: str, sort: list[str], row_bytes: float, most_file_bytes: int) -> None:
    """Replace the partitions that ``rows`` touch.  A partition of the lake is as many tasks as its size asks for (adaptive rebalancing splits a hot source
    and day and joins small ones), and a file holds about ``most_file_bytes`` at most."""
    most = max(1, int(most_file_bytes / max(1.0, row_bytes)))
    even = rows.hint("rebalance", *map(F.col, PARTS)).sortWithinPartitions(*PARTS, *sort)
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", most).partitionBy(*PARTS).parquet(path)


def _staged(spark: SparkSession, rows: DataFrame, stage: str) -> tuple[DataFrame, float]:
    """``rows`` written aside and read again, and the bytes of a row there."""
    rows.write.parquet(stage)
    back = spark.read.schema(rows.schema).parquet(stage)
    store, p = _files(spark, stage)
    return back, store.getContentSummary(p).getLength() / max(1, back.count())


def write(rows: DataFrame, path: str, key: str = "event_id", most_file_bytes: int = 128 << 20) -> None:
    """Append by key: of rows with one id the last written stays, so a replay changes nothing.

    Only the partitions that the batch touches are read and replaced (dynamic overwrite); their list, as long as the number of folders that are
    replaced, is what the driver sees.  A column that only the batch or only the stored rows have stays, null in the others.  The new content is
    staged first: what is read is never what is being overwritten.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    new = with_partitions(rows).withColumn("__age", F.lit(0))
    stage = f"{path}__stage_{uuid.uuid4().hex}"
    dirs = []
    if exists(spark, path):
        touched = [f"{path}/" + "/".join(f"{p}={r[p]}" for p in PARTS) for r in new.select(*PARTS).distinct().collect()]
        dirs = [d for d in touched if exists(spark, d)]
    if dirs:
        old = spark.read.schema(stored_schema(spark, path, dirs)).option("basePath", path).parquet(*dirs)
        new = new.unionByName(old.withColumn("__age", F.lit(1)), allowMissingColumns=True)
    back, row_bytes = _staged(spark, latest_by(new, [*PARTS, key], [F.col("__age"), F.desc("produced_at")]).drop("__age"), stage)
    _place(back, path, [key], row_bytes, most_file_bytes)
    delete(spark, stage)


def _fingerprint(rows: DataFrame) -> DataFrame:
    """Per partition: rows and an order-free sum of hashes of whole rows."""
    whole = F.xxhash64(F.to_json(F.struct(*[c for c in rows.columns if c not in PARTS]), {"ignoreNullFields": "false"}))
    return rows.groupBy(*PARTS).agg(F.count(F.lit(1)).alias("rows"), F.sum(whole.cast("decimal(20,0)")).alias("hash"))


def compact(spark: SparkSession, path: str, least_files: int = 5, most_file_bytes: int = 128 << 20) -> DataFrame:
    """Merge the files of every partition that has ``least_files`` or more; (partition, files before, rows).

    All partitions are done by one job, with the columns of all their files.  Before anything is replaced, the staged copy's columns, and each
    partition's rows as a multiset, are compared with the source; the report is written beside the lake, so no list of partitions reaches the driver.
    """
    path = path.rstrip("/")
    fields = "source_part string, year string, month string, day string, files_before long, rows long"
    if not exists(spark, path):
        return spark.createDataFrame([], fields)
    stage, report = f"{path}__stage_{uuid.uuid4().hex}", f"{path}__compacted_{uuid.uuid4().hex}"
    found = discover(spark, path).filter(F.col("file_count") >= least_files).select(*PARTS, F.col("file_count").alias("files_before"))
    if found.isEmpty():
        return spark.createDataFrame([], fields)
    whole = stored_schema(spark, path)
    source = spark.read.schema(whole).parquet(path).join(found.select(*PARTS), PARTS, "left_semi")
    back, row_bytes = _staged(spark, source, stage)
    before, after = _fingerprint(source), _fingerprint(back)
    equal = before.join(after.withColumnsRenamed({"rows": "n", "hash": "h"}), PARTS, "full_outer").filter(~(F.col("rows").eqNullSafe(F.col("n")) & F.col("hash").eqNullSafe(F.col("h")))).isEmpty()
    if not equal or set(spark.read.parquet(stage).columns) != set(whole.names):
        delete(spark, stage)
        raise RuntimeError("staged rows differ from the source; nothing was replaced")
    found.join(after, PARTS).select(*PARTS, "files_before", "rows").orderBy(*PARTS).write.parquet(report)
    _place(back, path, [], row_bytes, most_file_bytes)
    delete(spark, stage)
    return spark.read.schema(fields).parquet(report)


def try_read(spark: SparkSession, *paths: str) -> DataFrame | None:
    """The Parquet files of a list of paths, or None if none is there."""
    try:
        return spark.read.parquet(*paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
