"""Approximate nearest neighbours by an inverted multi-index.

A vector's two halves are quantised separately, so ``centroids`` codewords each give a grid of
``centroids ** 2`` cells. No inner product of a query half with a vector half exceeds that with its
codeword plus the norm of the query half times the largest residual there. For a query the cells
are visited in descending order of the two halves' summed bounds, kept in a heap (the
multi-sequence algorithm), down to the k-th largest inner product with the sample: no cell behind
that holds one of the k best, whatever the norms. The entries of cells visited are compared exactly.

That bound is the worst case, and on most vectors it lets few cells go. ``recall`` below 1 stops
sooner, at a number of rows measured on the sample: TRIED of its vectors are asked, and it is
the least that reaches the cells of that share of their k best. The residuals' part in the order of
the cells is weighed by what needs the fewest rows.

The codebooks are fitted on SAMPLE vectors at most, those with the smallest hash of their id;
every vector is indexed. The number of codewords grows with the fourth root of the number of
vectors, so the table of cell sizes, all that a query needs besides the codebooks, with its
square root.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.groups import configure
from tilewright.llm.vectors import ROWS, best, blocks, matrix, ranked, usable
from tilewright.llm.words import mix
from tilewright.staging import stage

K, EVERY, SAMPLE, ROUNDS = 20, 20, 20_000, 12
#: Share of the k best that a search which stops early has to reach in the sample, its trial queries
#: there, and the weights of the residuals that are tried.
RECALL, TRIED, WEIGHTS = 0.97, 256, (0.0, 0.25, 0.5, 1.0)
#: Rows of a cell that meet queries in one place; larger cells are cut by a hash of the id.
PART = 4 * ROWS
#: Queries that meet the sample at once.
ASKED = 64
#: Results held back in a task before they are cut to the k best per query.
HELD = 1 << 19
FOUND = "query_id long, vec_id long, score double"


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ book.T + (book**2).sum(axis=1)


def codebook(x: np.ndarray, size: int) -> np.ndarray:
    """k-means; empty codewords stay where they are."""
    book = x[np.random.default_rng(1).permutation(len(x))[:size]].copy()
    for _ in range(ROUNDS):
        nearest = distances(x, book).argmin(axis=1)
        for c in np.unique(nearest):
            book[c] = x[nearest == c].mean(axis=0)
    return book


def visit(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, wanted: float, limit: float = np.inf) -> list[int]:
    """Cells in ascending order of the sum of both sides, until they hold ``wanted`` vectors or sums
    are beyond ``limit``."""
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    heap, cells, found = [(a[0] + b[0], 0, 0)], [], 0
    while heap and found < wanted:
        behind, i, j = heapq.heappop(heap)
        if behind > limit:
            break
        cell = int(rows[i]) * len(b) + int(columns[j])
        if sizes[cell]:
            cells.append(cell)
            found += int(sizes[cell])
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):  # each pair is reached one way only
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def least_scores(ids: np.ndarray, asked: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """What the k best inner products of each query reach at least: the k-th best within the sample."""
    out = np.full(len(ids), -np.inf)
    if len(sample) <= k:
        return out
    for a in range(0, len(ids), ASKED):
        near = asked[a : a + ASKED] @ sample.T
        near[ids[a : a + ASKED, None] == sample_ids[None, :]] = -np.inf
        out[a : a + ASKED] = -np.partition(-near, k - 1, axis=1)[:, k - 1]
    return out


def floors(ids: np.ndarray, asked: np.ndarray, visited: list, sample_ids: np.ndarray, sample: np.ndarray,
           cells: np.ndarray, count: int, k: int) -> np.ndarray:
    """What the k best of what each query visits reach at least: the k-th best of the sample there."""
    out = np.full(len(ids), -np.inf)
    if len(sample) <= k:
        return out
    for i, (own, v, seen) in enumerate(zip(ids, asked, visited)):
        there = np.zeros(count, bool)
        there[seen] = True
        near = (sample @ v)[there[cells] & (sample_ids != own)]
        if len(near) >= k:
            out[i] = -np.partition(-near, k - 1)[k - 1]
    return out


def rows_needed(order: np.ndarray, grid: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Rows in the cells before each of ``cells`` where cells are visited in ascending ``order``."""
    by = np.argsort(order, kind="stable")
    before = np.empty(len(grid), np.int64)
    before[by] = np.cumsum(grid[by]) - grid[by]
    return before[cells]


def cells_of(x: np.ndarray, books: list) -> np.ndarray:
    half = x.shape[1] // 2
    left = distances(x[:, :half], books[0]).argmin(axis=1)
    return left * len(books[1]) + distances(x[:, half:], books[1]).argmin(axis=1)


def stop_at(sample_ids: np.ndarray, sample: np.ndarray, books: list, grid: np.ndarray, reach: list, k: int,
            recall: float) -> tuple[float, float]:
    """The rows after which a search may stop, and the weight of the residuals with which they are fewest."""
    if len(sample) <= k:
        return np.inf, 1.0
    half, cells = sample.shape[1] // 2, cells_of(sample, books)
    needed: dict[float, list] = {weight: [] for weight in WEIGHTS}
    for own, v in zip(sample_ids[:TRIED], sample[:TRIED]):
        near = sample @ v
        near[sample_ids == own] = -np.inf
        top = np.argpartition(-near, k - 1)[:k]
        sides = [(-book @ part, -np.sqrt(part @ part) * far) for book, part, far in zip(books, (v[:half], v[half:]), reach)]
        for weight in WEIGHTS:
            left, right = (a + weight * b for a, b in sides)
            needed[weight].append(rows_needed((left[:, None] + right).ravel(), grid, cells[top]))
    rows = {w: np.quantile(np.concatenate(x), recall, method="higher") + 1 for w, x in needed.items()}
    weight = min(WEIGHTS, key=rows.__getitem__)
    return max(float(rows[weight]), 2.0 * k + 1), weight


def _search(batches, k: int):
    """Blocks of queries against blocks of the same cell."""
    held, size = [], 0

    def flush():
        query, ids, score = (np.concatenate(x) for x in zip(*held))
        at = best(query, ids, score, k)
        return query[at], ids[at], score[at]

    for batch in batches:
        for row in batch.to_pylist():
            ids, own = (np.frombuffer(row[c], np.int64) for c in ("ids", "asked_ids"))
            rows = np.frombuffer(row["body"]).reshape(-1, row["size"])
            asked = np.frombuffer(row["asked"]).reshape(-1, row["size"] + 1)
            asked, floor = asked[:, :-1], asked[:, -1:]
            near = asked @ rows.T
            near[own[:, None] == ids[None, :]] = -np.inf
            # all that may be among the k best, rounding allowed for
            tolerance = 1e-12 * np.sqrt((asked**2).sum(1)[:, None] * (rows**2).sum(1).max())
            if len(ids) > k:
                floor = np.maximum(floor, -np.partition(-near, k - 1, axis=1)[:, k - 1 : k])
            q, r = np.nonzero((near >= floor - tolerance) & (near > -np.inf))
            # equal vectors must get equal scores: one order of summation for all
            score = (asked[q] * rows[r]).sum(axis=1)
            held.append((own[q], ids[r], score))
            size += len(q)
            if size >= HELD:
                held = [flush()]
                size = len(held[0][0])
                if size >= HELD // 2:
                    yield held.pop()
                    size = 0
    if held:
        yield flush()


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, share: float = 1.0, recall: float = 1.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every ``every``-th id, the k largest inner products.

    All of them with ``recall`` 1; below, a query stops where that share was reached in the sample, and
    with ``share`` below 1 at cells that hold that share of all vectors. Ties go to smaller ids; an
    empty table gives no rows. See :func:`tilewright.llm.vectors.usable` for the vectors that take
    part; zero vectors do not. Vectors of another length than the commonest are compared on their
    own length only, in a cell of their own.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS // 4))
    whole = stage(usable(vectors, zero=False), "vectors")
    lengths = whole.groupBy(F.size("embedding").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), "size").first()
    width, total = (common["size"], common["count"]) if common else (2, 0)
    others = whole.filter(F.size("embedding") != width).count()
    sample = whole.filter(F.size("embedding") == width).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    x = np.array([r["embedding"] for r in sample]).reshape(-1, width)
    sample_ids = np.array([r["vec_id"] for r in sample], np.int64)
    half = width // 2
    count = max(16, math.ceil(max(total, 1) ** 0.25))
    books = [codebook(part, count) for part in (x[:, :half], x[:, half:])] if len(x) else []

    def halves(v: np.ndarray):
        return (v[:, :half], books[0]), (v[:, half:], books[1])

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                column = batch.column("embedding")
                cell, far = np.full(len(column), -1, np.int64), np.zeros((2, len(column)))
                mine = np.flatnonzero(column.value_lengths().to_numpy(zero_copy_only=False) == width)
                if len(mine):
                    cell[mine] = 0
                    for side, (part, book) in enumerate(halves(matrix(column.take(pa.array(mine))))):
                        code = distances(part, book).argmin(axis=1)
                        cell[mine] = cell[mine] * len(book) + code
                        far[side, mine] = np.sqrt(((part - book[code]) ** 2).sum(axis=1))
                columns = [pa.array(cell), *batch.columns, pa.array(far[0]), pa.array(far[1])]
                yield pa.record_batch(columns, names=["cell", "vec_id", "embedding", "far_left", "far_right"])

    shape = "cell long, vec_id long, embedding array<double>"
    placed = stage(whole.mapInArrow(index, shape + ", far_left double, far_right double"), "cells")
    # one row per cell, about the square root of the number of vectors
    sides = tuple(len(book) for book in books) if books else (1, 1)
    grid, reach = np.zeros(sides[0] * sides[1], np.int64), [np.zeros(n) for n in sides]
    sums = [F.count("*").alias("n"), F.max("far_left").alias("left"), F.max("far_right").alias("right")]
    for row in placed.filter("cell >= 0").groupBy("cell").agg(*sums).collect():
        grid[row["cell"]] = row["n"]
        for side, code in enumerate(divmod(row["cell"], sides[1])):
            reach[side][code] = max(reach[side][code], row[("left", "right")[side]])
    wanted, weight = share * grid.sum() if share < 1 else np.inf, 1.0
    if recall < 1 and len(x):
        wanted, weight = stop_at(sample_ids, x, books, grid, reach, k, recall)
    sample_cells = cells_of(x, books) if len(x) else np.zeros(0, np.int64)
    # routes: the parts of each cell, those of cell -1 first
    parts = np.maximum(1, -(-np.concatenate(([others], grid)) // PART))
    routes = np.concatenate(([0], np.cumsum(parts)))
    longest = max((np.sqrt((book**2).sum(axis=1)) + far).max() for book, far in zip(books, reach)) if books else 0.0

    def ask(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("embedding")
            mine = np.flatnonzero(column.value_lengths().to_numpy(zero_copy_only=False) == width)
            visited, floor = [[-1]] * batch.num_rows, np.full(batch.num_rows, -np.inf)
            if len(mine):
                v = matrix(column.take(pa.array(mine)))
                left, right = (
                    -(part @ book.T + weight * np.sqrt((part**2).sum(axis=1))[:, None] * far)
                    for (part, book), far in zip(halves(v), reach)
                )
                least = np.full(len(v), -np.inf)  # the bound holds for whole residuals only
                if recall == 1:
                    least = least_scores(batch.column("vec_id").to_numpy()[mine], v, sample_ids, x, k)
                slack = 1e-9 * np.sqrt((v**2).sum(axis=1)) * longest  # rounding
                for place, a, b, limit in zip(mine.tolist(), left, right, slack - least):
                    visited[place] = visit(a, b, grid, wanted, limit)
                own, seen = batch.column("vec_id").to_numpy()[mine], [visited[i] for i in mine.tolist()]
                floor[mine] = floors(own, v, seen, sample_ids, x, sample_cells, len(grid), k)
            # what a query need not look below travels as its last component
            column = pa.array([[*v, f] for v, f in zip(column.to_pylist(), floor.tolist())], pa.list_(pa.float64()))
            row = np.repeat(np.arange(batch.num_rows), [len(x) for x in visited])
            cell = np.array([c for x in visited for c in x], np.int64)
            each = parts[cell + 1]
            row, first = np.repeat(row, each), np.repeat(routes[cell + 1], each)
            cell = first + np.arange(len(first)) - np.repeat(np.cumsum(each) - each, each)
            for a in range(0, len(row), ROWS):  # a query goes to many cells: not all copies at once
                at = pa.array(row[a : a + ROWS])
                columns = [pa.array(cell[a : a + ROWS]), batch.column("vec_id").take(at), column.take(at)]
                yield pa.record_batch(columns, names=["cell", "vec_id", "embedding"])

    def routed(batches):
        for batch in batches:
            cell, ids = (batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "vec_id"))
            part = (mix(ids.view(np.uint64)) % parts[cell + 1].astype(np.uint64)).astype(np.int64)
            yield batch.set_column(0, "cell", pa.array(routes[cell + 1] + part))

    placed = placed.select("cell", "vec_id", "embedding").mapInArrow(routed, shape)
    indexed = blocks(placed.repartition("cell"), ["cell"], ROWS // 4, "index").drop("uid")
    asked = whole.filter(F.col("vec_id") % every == 0).mapInArrow(ask, shape)
    asked = blocks(asked, ["cell"], ROWS // 4, "asked").drop("uid")
    asked = asked.withColumnsRenamed({"ids": "asked_ids", "body": "asked"})
    asked = asked.withColumn("size", F.col("size") - 1)
    configure(spark)
    pairs = indexed.join(asked, ["cell", "size"]).select("size", "ids", "body", "asked_ids", "asked")

    def run(batches):
        for arrays in _search(batches, k):
            yield pa.record_batch([pa.array(x) for x in arrays], names=["query_id", "vec_id", "score"])

    return ranked(pairs.mapInArrow(run, FOUND), k)
