"""Incremental ingest: new item files become keyed deltas, merged when read or compacted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tilewright.operators.upsert import latest
from tilewright.sources.catalog import child_directories

BATCH = "batch_no"
# Where a row comes from: its file, the first byte of the part of it that a task has read, and
# its number there. With the batch, a total order of arrival.
PLACE = ("_file", "_block", "_row")
ARRIVAL = (BATCH, *PLACE)
_PLACES = [StructField(n, StringType() if n == "_file" else LongType()) for n in PLACE]


def ingest(
    spark: SparkSession,
    source: str,
    table: str,
    schema: StructType,
    checkpoint: str,
    files_per_batch: int = 1000,
    form: str = "json",
) -> None:
    """Take in the files that arrived since the last call, then stop.

    The checkpoint takes the place of a progress log. A micro-batch overwrites its own delta
    directory, so a batch that is repeated after a failure leaves the same rows once.
    """
    stream = (
        spark.readStream.schema(schema)
        .format(form)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    )

    def write_delta(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("_row", F.monotonically_increasing_id())
        placed.write.mode("overwrite").parquet(f"{table}/{BATCH}={number}")

    query = (
        stream.writeStream.foreachBatch(write_delta)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def deltas(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """Every row taken in and not yet compacted, with its place and batch number."""
    fields = StructType([*schema.fields, *_PLACES, StructField(BATCH, LongType())])
    batches = [d for d in child_directories(spark, table) if d.startswith(f"{BATCH}=")]
    if not batches:
        return spark.createDataFrame([], fields)
    paths = [f"{table}/{d}" for d in batches]
    return spark.read.schema(fields).option("basePath", table).parquet(*paths)


def current(
    spark: SparkSession,
    table: str,
    schema: StructType,
    key: list[str],
    order: list[str],
    base: DataFrame | None = None,
) -> DataFrame:
    """The last row per key over a base snapshot and the deltas.

    ``order`` names columns that order the rows totally, ARRIVAL for the order of arrival: by
    batch, file and line. Rows of the snapshot come before all batches.
    """
    rows = deltas(spark, table, schema)
    if base is not None:
        old = base.withColumn(BATCH, F.lit(-1).cast("bigint"))
        rows = rows.unionByName(old, allowMissingColumns=True)
    return latest(rows, key, order).drop(*ARRIVAL)


def compact(
    spark: SparkSession,
    table: str,
    schema: StructType,
    key: list[str],
    order: list[str],
    target: str,
    base: DataFrame | None = None,
    retire: bool = False,
) -> None:
    """Write the current rows as a new snapshot at ``target``.

    With ``retire`` the deltas in it are deleted once it is written, and what is read from
    then on starts from the snapshot. Should that end half way, deltas left behind are applied
    again, which changes nothing.
    """
    held = [d for d in child_directories(spark, table) if d.startswith(f"{BATCH}=")]
    current(spark, table, schema, key, order, base).write.mode("errorifexists").parquet(target)
    for name in held if retire else ():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
