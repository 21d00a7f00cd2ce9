"""Keyed deltas in hash buckets, merged level by level.

A run is a directory of rows, the last one per key, split by a hash of the key. Each batch is
a run of level 0; as soon as ``fanout`` runs of one level are there, they become one run of the
next. So after k batches there are about ``fanout`` runs for each of log(k) levels to read, and a row
is written log(k) times, not k times. A run is named by the batches in it: one that is written but
whose parts are not deleted yet hides them, so a merge that dies loses and repeats nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tilewright.operators.upsert import latest
from tilewright.sources.catalog import child_directories, delete_path, path_exists
from tilewright.streaming.ingest import _PLACES, ARRIVAL, BATCH

BUCKET = "bucket"


@dataclass(frozen=True)
class Layout:
    """Where runs lie and what they hold. ``order`` orders the rows of a key totally; with ARRIVAL it
    is the order of batch, file and line. ``buckets`` and ``key`` stay as they were at first."""

    table: str
    schema: StructType
    key: tuple[str, ...]
    order: tuple[str, ...] = ARRIVAL
    buckets: int = 64
    fanout: int = 8

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def fields(self) -> StructType:
        return StructType([*self.schema.fields, *_PLACES, StructField(BATCH, LongType()), StructField(BUCKET, IntegerType())])


@dataclass(frozen=True, order=True)
class Run:
    first: int
    last: int
    level: int

    def path(self, table: str) -> str:
        return f"{table}/level={self.level}/run={self.first}-{self.last}"


def _finished(spark: SparkSession, layout: Layout) -> list[Run]:
    out = []
    for level in child_directories(spark, layout.table):
        for name in child_directories(spark, f"{layout.table}/{level}") if level.startswith("level=") else ():
            first, _, last = name.removeprefix("run=").partition("-")
            run = Run(int(first), int(last), int(level.removeprefix("level=")))
            if path_exists(spark, f"{run.path(layout.table)}/_SUCCESS"):
                out.append(run)
    return out


def runs(spark: SparkSession, layout: Layout) -> list[Run]:
    """The runs in force, in order of their batches: finished ones that no higher one has in it."""
    found = _finished(spark, layout)

    def hidden(run: Run) -> bool:
        return any(r.level > run.level and r.first <= run.first and run.last <= r.last for r in found)

    return sorted(r for r in found if not hidden(r))


def _write(rows: DataFrame, layout: Layout, run: Run) -> None:
    """The last row per key; a bucket is one file, or more where it is large."""
    last = latest(rows, list(layout.key), list(layout.order)).withColumn(BUCKET, layout.bucket())
    last = last.select(*[F.col(f"`{c}`") for c in layout.fields().names])
    last.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(BUCKET).parquet(run.path(layout.table))


def read_runs(spark: SparkSession, layout: Layout, some: list[Run], buckets: list[int] | None = None) -> DataFrame:
    """Rows of runs, of some buckets only or of all; the others' directories are not opened."""
    if not some:
        return spark.createDataFrame([], layout.fields())
    parts = []
    for run in some:
        path = run.path(layout.table)
        rows = spark.read.schema(layout.fields()).option("basePath", path).parquet(path)
        parts.append(rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merge_levels(spark: SparkSession, layout: Layout) -> list[Run]:
    """Merge full levels, lowest first, and delete what is hidden. Returns the runs written.

    Only the runs of a full level are read; what lies on higher levels stays as it is.
    """
    written = []
    while True:
        live = runs(spark, layout)
        for run in set(_finished(spark, layout)) - set(live):
            delete_path(spark, run.path(layout.table))
        levels = sorted({r.level for r in live if sum(x.level == r.level for x in live) >= layout.fanout})
        if not levels:
            return written
        some = [r for r in live if r.level == levels[0]][: layout.fanout]
        merged = Run(some[0].first, some[-1].last, levels[0] + 1)
        _write(read_runs(spark, layout, some), layout, merged)
        written.append(merged)


def add_batch(rows: DataFrame, layout: Layout, number: int) -> None:
    """Take in batch ``number``, rows with the places they came from. A repeated one changes nothing."""
    spark = rows.sparkSession
    if any(r.first <= number <= r.last and r.level for r in runs(spark, layout)):
        return  # it has been merged already
    _write(rows.withColumn(BATCH, F.lit(number).cast("bigint")), layout, Run(number, number, 0))
    merge_levels(spark, layout)


def ingest(
    spark: SparkSession, source: str, layout: Layout, checkpoint: str, files_per_batch: int = 1000, form: str = "json"
) -> None:
    """Take in the files that arrived since the last call, then stop."""
    stream = (
        spark.readStream.schema(layout.schema)
        .format(form)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    )

    def take(batch: DataFrame, number: int) -> None:
        add_batch(batch.withColumn("_row", F.monotonically_increasing_id()), layout, number)

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current(spark: SparkSession, layout: Layout, keys: DataFrame | None = None) -> DataFrame:
    """The last row per key, of all keys or of those in ``keys``, whose buckets alone are opened."""
    buckets = None
    if keys is not None:  # at most as many numbers as there are buckets
        buckets = [r[0] for r in keys.select(layout.bucket()).distinct().collect()]
    rows = read_runs(spark, layout, runs(spark, layout), buckets)
    if keys is not None:
        rows = rows.join(keys.select(*layout.key).distinct(), list(layout.key), "left_semi")
    return latest(rows, list(layout.key), list(layout.order)).select(*[F.col(f"`{c}`") for c in layout.schema.names])
