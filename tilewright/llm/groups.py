"""Documents in groups of a few megabytes: written once, then joined and read group by group."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.staging import stage

GROUP_BYTES = 2 << 20
# Rows that cross to Python at once; texts and blobs are large.
BATCH_ROWS = 64
WORDS_PER_BUCKET = 1 << 20
LEAST_BUCKETS = 256


def configure(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _write(table: pa.Table) -> bytes:
    batch = table.combine_chunks().to_batches()[0]
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_group(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as reader:
        return reader.read_next_batch()


def _grouped(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    base, number, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

    def row() -> pa.RecordBatch:
        return pa.record_batch(
            {"gid": pa.array([base + number], pa.int64()),
             "body": pa.array([_write(pa.Table.from_batches(held))], pa.binary())}
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield row()
            number, held, size = number + 1, [], 0
    if held:
        yield row()


def group_documents(docs: DataFrame, name: str, least: int = GROUP_BYTES) -> DataFrame:
    """``(gid, body)``: rows of ``docs`` as compressed Arrow batches of about ``least`` bytes."""
    configure(docs.sparkSession)
    return stage(docs.mapInArrow(lambda batches: _grouped(batches, least), "gid long, body binary"), name)


def attach(groups: DataFrame, blobs: DataFrame) -> DataFrame:
    """To each group the rows ``(gid, blob, more)`` meant for it, as one list.

    A group gets one row per bucket at most, all about its own words, so the list is bounded.
    """
    held = blobs.groupBy("gid").agg(F.collect_list(F.struct("blob", "more")).alias("blobs"))
    return groups.join(held, "gid", "left")


def bucket_count(text_bytes: int) -> int:
    """Buckets for what is gathered per word, in proportion to the bytes of all texts."""
    return max(LEAST_BUCKETS, text_bytes // (6 * WORDS_PER_BUCKET))
