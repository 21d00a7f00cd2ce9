"""Vectors in blocks, and the best results of each query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.staging import stage

ROWS = 4096
#: Components held back in a task while blocks fill up; beyond, all blocks go as they are.
HELD = 1 << 22


def usable(vectors: DataFrame, zero: bool = True) -> DataFrame:
    """``vec_id, embedding`` (doubles) of vectors that take part.

    Vectors that are null, empty, or hold null or non-finite components do not, nor do those without
    an id; with ``zero=False``, zero vectors neither. Of rows sharing an id the smallest
    vector counts. Other columns play no part.
    """
    doubles = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), doubles.alias("embedding"))
    kept = kept.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).filter(fine)
    if not zero:
        kept = kept.filter(F.exists("embedding", lambda x: x != 0))
    return kept.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(vectors: DataFrame, keys: list[str], rows: int, name: str) -> DataFrame:
    """Staged ``keys..., size, ids, body``: up to ``rows`` vectors of equal keys and length.

    ``vectors`` has the keys (integers), ``vec_id`` and ``embedding``.
    """
    schema = "".join(f"{k} long, " for k in keys) + "size int, uid long, ids binary, body binary"
    names = [*keys, "size", "uid", "ids", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, held, waiting = TaskContext.get().partitionId() << 32, 0, {}, 0

        def block(key) -> pa.RecordBatch:
            nonlocal number, waiting
            number += 1
            waiting -= sum(x[1].size for x in held[key])
            ids, body = (np.concatenate(x) for x in zip(*held.pop(key)))
            row = [*key, base + number, ids.tobytes(), np.ascontiguousarray(body).tobytes()]
            return pa.record_batch([pa.array([x]) for x in row[: len(keys)]]
                                   + [pa.array([key[-1]], pa.int32()), pa.array([base + number], pa.int64())]
                                   + [pa.array([x], pa.binary()) for x in row[-2:]], names=names)

        for batch in batches:
            size = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            own = np.column_stack([*(batch.column(k).to_numpy() for k in keys), size]).astype(np.int64)
            if not len(own):
                continue
            ids = batch.column("vec_id").to_numpy()
            order = np.lexsort(own.T[::-1])
            cuts = np.flatnonzero((np.diff(own[order], axis=0, prepend=own[order][:1] - 1) != 0).any(axis=1))
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(size) - size
            for at in np.split(order, cuts[1:]):
                key = tuple(own[at[0]].tolist())
                body = flat[starts[at][:, None] + np.arange(key[-1])]
                for a in range(0, len(at), rows):
                    have = held.setdefault(key, [])
                    have.append((ids[at[a : a + rows]], body[a : a + rows]))
                    waiting += have[-1][1].size
                    if sum(len(x[0]) for x in have) >= rows:
                        yield block(key)
            if waiting > HELD:
                for key in list(held):
                    yield block(key)
        for key in list(held):
            yield block(key)

    wide = vectors.select(*[F.col(k).cast("bigint").alias(k) for k in keys], "vec_id", "embedding")
    return stage(wide.mapInArrow(run, schema), name)


def numbered(blocks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Blocks with numbers from 0 in place of ``uid``; only uids go through the window."""
    order = W.partitionBy(F.lit(0)).orderBy("uid")
    numbers = blocks.select("uid", (F.row_number().over(order) - 1).alias(name))
    return blocks.join(numbers, "uid").drop("uid"), blocks.count()


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores per query, ties to smaller ids, in that order."""
    order = np.lexsort((ids, -score, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: of what tasks have found, the k best per query."""
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
