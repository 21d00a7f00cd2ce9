"""Exact top-k by integer inner product with Fagin's threshold algorithm.

Per block of candidates and dimension there is a list sorted by that component. For a query, the
lists are read from the end that its component favours, a step deeper into all of them at a time;
vectors met for the first time are scored. No vector still unseen can score more than the
sum over dimensions of query times the component read last, so reading stops when the kth
result is above that bound (not at it: an unseen vector could tie with a smaller id).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.groups import configure
from tilewright.llm.vectors import ROWS, best, blocks, numbered, ranked, usable

K, EVERY, SCALE, QUERIES, DEPTH = 5, 50, 256, 1024, 32
_EXACT = 2.0**53
FOUND = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    scaled = F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))
    return usable(vectors).select("vec_id", scaled.alias("embedding"))


def threshold_search(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, lists: np.ndarray, k: int):
    """Places and scores of the k best rows for a query; row ``own`` takes no part.

    ``lists`` holds per column the places of the rows in ascending order of that component.
    """
    n = len(ids)
    used = np.flatnonzero(query)
    down = query[used] > 0
    seen = ids == own
    top, score = np.zeros(0, np.int64), np.zeros(0, query.dtype)
    depth, step = 0, DEPTH
    if not len(used):  # every row scores 0
        places = np.flatnonzero(~seen)
        return places[np.argsort(ids[places])[:k]], np.zeros(min(k, len(places)), query.dtype)
    while depth < n:
        stop = min(n, depth + step)
        reads = np.where(down, n - 1 - np.arange(depth, stop)[:, None], np.arange(depth, stop)[:, None])
        places = lists[reads, used]
        new = np.zeros(n, bool)
        new[places.ravel()] = True
        new = np.flatnonzero(new & ~seen)
        seen[new] = True
        top, score = np.concatenate((top, new)), np.concatenate((score, rows[new] @ query))
        order = np.lexsort((ids[top], -score))[:k]
        top, score = top[order], score[order]
        bound = (query[used] * rows[places[-1], used]).sum()
        if len(top) == k and score[-1] > bound:
            break
        depth, step = stop, 2 * step
    return top, score


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every ``every``-th id, the k best of all other rows.

    See :func:`tilewright.llm.vectors.usable` for the vectors that take part. Vectors meet those of
    their own length only. Scores are exact while they and their terms fit a long. Blocks of
    queries meet blocks of candidates; the k best of each pair of blocks are ranked at the end.
    """
    configure(vectors.sparkSession)
    whole = integers(vectors, scale)
    candidates, n = numbered(blocks(whole, [], ROWS, "candidates"), "candidate")
    asked = whole.filter(F.col("vec_id") % every == 0)
    queries, m = numbered(blocks(asked.repartition(8), [], QUERIES, "queries"), "query")

    def met(side: DataFrame, other: str, count: int, prefix: str) -> DataFrame:
        numbers = F.explode(F.sequence(F.lit(0), F.lit(max(count - 1, 0)))).alias(other)
        return side.select("*", numbers).withColumnsRenamed({"ids": f"{prefix}_ids", "body": prefix})

    left, right = met(candidates, "query", m, "rows"), met(queries, "candidate", n, "asked")
    pairs = left.join(right, ["candidate", "query", "size"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, own = (np.frombuffer(row[c], np.int64) for c in ("rows_ids", "asked_ids"))
                rows, asked = (np.frombuffer(row[c], np.int64).reshape(-1, row["size"]) for c in ("rows", "asked"))
                largest = float(np.abs(rows.astype(float)).max()) * float(np.abs(asked.astype(float)).max())
                kind = np.float64 if largest * row["size"] < _EXACT else np.int64
                rows, asked = rows.astype(kind), asked.astype(kind)
                lists = np.argsort(rows, axis=0, kind="stable")
                found = [threshold_search(q, i, ids, rows, lists, k) for q, i in zip(asked, own.tolist())]
                query = np.repeat(own, [len(x[0]) for x in found])
                places = np.concatenate([x[0] for x in found])
                score = np.concatenate([x[1] for x in found]).astype(np.int64)
                at = best(query, ids[places], score, k)
                arrays = [pa.array(x[at]) for x in (query, ids[places], score)]
                yield pa.record_batch(arrays, names=["query_id", "vec_id", "score"])

    wanted = pairs.select("size", "rows_ids", "rows", "asked_ids", "asked")
    return ranked(wanted.mapInArrow(run, FOUND), k)
