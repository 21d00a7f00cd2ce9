"""Region state: chunk manifest, counters, reconciliation with what is stored, resuming."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.names import chunk_id
from tilewright.schemas import REGION_STATE


_CHUNK = ("region", "year", "chunk")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksums of runs of lines with equal keys, fed run by run as they arrive."""
    key, digest, size, count = None, hashlib.md5(), 0, 0
    done: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = pd.DataFrame({c: batch.column(c).to_pandas() for c in _CHUNK})
        begins = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy() | (np.arange(len(keys)) == 0))
        lines = batch.column("line").to_pylist()
        for begin, end in zip(begins, [*begins[1:], len(lines)]):
            own = tuple(keys.iloc[begin])
            if key is not None and own != key:
                done.append((*key, size, digest.hexdigest(), count))
                digest, size, count = hashlib.md5(), 0, 0
            key, part = own, lines[begin:end]
            text = ("\n".join(part) + "\n").encode()
            digest.update(text)
            size += len(text)
            count += sum(bool(line.strip(" ")) for line in part)
        if done:
            yield _stats(done)
            done = []
    if key is not None:
        yield _stats([(*key, size, digest.hexdigest(), count)])


def _stats(rows: list[tuple]) -> pa.RecordBatch:
    columns = dict(zip((*_CHUNK, "size_bytes", "md5_hash", "item_count"), map(list, zip(*rows))))
    columns["chunk"] = pa.array(map(int, columns["chunk"]), pa.int32())
    return pa.record_batch(columns)


def chunk_stats(lines: DataFrame) -> DataFrame:
    """Bytes, MD5 and item count per stored chunk.

    ``lines`` has ``region, year, chunk, line_no, line``, none of them null. A checksum takes the
    lines of a chunk in order, so a chunk is one task's; they are sorted by Spark, which spills,
    and pass through the checksum batch by batch, so a chunk of any size needs no more memory.
    """
    ordered = lines.repartition(*_CHUNK).sortWithinPartitions(*_CHUNK, "line_no")
    ordered = ordered.select("region", "year", F.col("chunk").cast("int").alias("chunk"), "line")
    schema = "region string, year string, chunk int, size_bytes long, md5_hash string, item_count long"
    return ordered.mapInArrow(_digests, schema)


def manifest(stats: DataFrame) -> DataFrame:
    """Manifest rows of the chunks that were written."""
    return stats.withColumn("id", chunk_id(F.col("year"), F.col("chunk")))


def highest_chunks(chunks: DataFrame) -> DataFrame:
    """Highest chunk number per region and year, of a manifest or of stored chunk names."""
    return chunks.groupBy("region", "year").agg(F.max("chunk").alias("max_chunk"))


def counters(chunks: DataFrame) -> DataFrame:
    """The next chunk number per region and year."""
    return highest_chunks(chunks).select(
        "region", "year", (F.col("max_chunk") + 1).alias("counter")
    )


def out_of_sync(stored: DataFrame, recorded: DataFrame) -> DataFrame:
    """Per region and year: is a chunk stored that the manifest does not reach?"""
    have = highest_chunks(stored)
    known = highest_chunks(recorded).withColumnRenamed("max_chunk", "recorded_max")
    return have.join(known, ["region", "year"], "left").withColumn(
        "out_of_sync",
        F.col("recorded_max").isNull() | (F.col("max_chunk") > F.col("recorded_max")),
    )


def rebuild_manifest(stored: DataFrame, stats: DataFrame) -> DataFrame:
    """A manifest row for every number from 0 to the highest stored one.

    Numbers without statistics get an empty checksum and zero sizes.
    """
    full = highest_chunks(stored).select(
        "region", "year", F.explode(F.sequence(F.lit(0), F.col("max_chunk"))).alias("chunk")
    )
    joined = full.join(stats, ["region", "year", "chunk"], "left")
    return joined.select(
        "region",
        "year",
        "chunk",
        chunk_id(F.col("year"), F.col("chunk")).alias("id"),
        F.coalesce("size_bytes", F.lit(0)).cast("bigint").alias("size_bytes"),
        F.coalesce("md5_hash", F.lit("")).alias("md5_hash"),
        F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
    )


def missing_chunks(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Rows of chunks that the other side has and this one lacks."""
    keys = ["region", "year", "chunk"]
    return remote.join(local.select(*keys).distinct(), keys, "left_anti")


def advance(state: DataFrame, processed: DataFrame) -> DataFrame:
    """State after a run. ``processed`` has ``region, batch``, failed rows included."""
    done = processed.groupBy("region").agg(
        F.max("batch").alias("_batch"), F.count("*").alias("_n")
    )
    return state.join(done, "region", "full_outer").select(
        "region",
        F.coalesce("_batch", "last_batch").cast("bigint").alias("last_batch"),
        (F.coalesce("total_files_processed", F.lit(0)) + F.coalesce("_n", F.lit(0)))
        .cast("bigint")
        .alias("total_files_processed"),
    )


def resume_from(state: DataFrame, progress: DataFrame) -> DataFrame:
    """State with the resume point of a progress record ``(region, counter)`` where there is one."""
    return state.join(progress, "region", "left").select(
        "region",
        F.coalesce("counter", "last_batch").cast("bigint").alias("last_batch"),
        "total_files_processed",
    )


def reset_state(spark: SparkSession, state: DataFrame | None = None) -> DataFrame:
    """State for doing everything again: no batch finished, nothing processed."""
    if state is None:
        return spark.createDataFrame([], REGION_STATE)
    return state.select(
        "region",
        F.lit(-1).cast("bigint").alias("last_batch"),
        F.lit(0).cast("bigint").alias("total_files_processed"),
    )
