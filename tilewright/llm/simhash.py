"""Near-duplicates by SimHash, with pivot distance tables.

A fingerprint sums up the shingles of a text; texts with few differing bits are near-duplicates.
The distances of every fingerprint to PIVOTS reference fingerprints are tabulated. By the triangle
inequality two fingerprints within ``distance`` bits of each other differ by no more than that
in each coordinate, so pairs with a larger difference are discarded without comparing them; the
others are verified. Pairs are looked for among fingerprints that agree in two of
``distance + 2`` bands of bits, which every pair within ``distance`` does.

Equal fingerprints are one node, whatever the number of documents. A crowded cell of bands is cut
into parts which meet two by two. Only a spanning forest of the pairs found leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.components import components
from tilewright.llm.groups import configure
from tilewright.llm.words import Words, mix
from tilewright.staging import stage

SHINGLE, DISTANCE, SEED = 4, 4, 42
PIVOTS = 16
#: Fingerprints of a cell that are compared in one piece, and pairs looked at together.
PART, PAIRS = 4096, 1 << 20
ROWS = 10_000


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the shingles of all texts, and how many each text has."""
    counts = np.diff(words.first)
    raw = words.data.tobytes()
    bounds = zip(words.bounds[:-1][counts > 0].tolist(), words.bounds[1:][counts > 0].tolist())
    joined = b" ".join(b" ".join(raw[a:b].split()) for a, b in bounds)
    length = words.ends - words.starts
    starts = np.cumsum(length + 1) - (length + 1)
    place = np.arange(len(words)) - words.first[words.doc]
    begins = np.flatnonzero((place + size <= counts[words.doc]) | (place == 0))
    lasts = np.minimum(begins + size, words.first[words.doc[begins] + 1]) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[begins].tolist(), (starts[lasts] + length[lasts]).tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(begins))
    return hashes, np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the bits set in more than half of its hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    begins = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
    sums = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    chosen = np.packbits(2 * sums > counts[full, None], axis=1, bitorder="little")
    out[full] = np.ascontiguousarray(chosen).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp``: the fingerprint as a signed long; zero where there are no words."""
    docs = docs.drop("fp")
    schema = T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                words = Words(batch.column("text"), lower=True)
                fp = majority(*shingle_hashes(words, shingle)).view(np.int64)
                yield pa.record_batch([*batch.columns, pa.array(fp)], names=schema.names)

    configure(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def _bands(distance: int) -> list[tuple[int, int]]:
    """Low bit and width of each of ``distance + 2`` bands."""
    cuts = [round(64 * i / (distance + 2)) for i in range(distance + 3)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def cells(nodes: DataFrame, distance: int) -> DataFrame:
    """Rows ``key, a, b, part, fp``: fingerprints that meet in a cell, in parts a and b of it."""
    def band(low: int, width: int):
        return F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1)

    keys = [
        F.shiftleft(band(*x), 16 + 22).bitwiseOR(F.shiftleft(band(*y), 8)).bitwiseOR(F.lit(number))
        for number, (x, y) in enumerate(combinations(_bands(distance), 2))
    ]
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    crowded = keyed.groupBy("key").count().filter(F.col("count") > PART)
    crowded = crowded.select("key", F.ceil(F.col("count") / PART).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    split = keyed.join(crowded, "key", "left").fillna(1, ["parts"]).withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    met = split.select("key", "part", "fp", other)
    pair = [F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")]
    return met.select("key", *pair, "part", "fp")


def close_pairs(fp: np.ndarray, left: np.ndarray, right: np.ndarray, table: np.ndarray, distance: int):
    """Of pairs of places, those within ``distance``: discarded by the table first, then verified."""
    for column in table:
        gap = np.abs(column[left] - column[right])
        left, right = left[gap <= distance], right[gap <= distance]
    near = np.bitwise_count(fp[left] ^ fp[right]) <= distance
    return left[near], right[near]


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Distances to the reference fingerprints, one row for each of these."""
    pivots = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64))
    return np.bitwise_count(fp[None, :] ^ pivots[:, None]).astype(np.int8)


def forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray | None = None) -> np.ndarray:
    """A label for each of n places, the same for places that pairs connect."""
    label = np.arange(n) if label is None else label
    left, right = (np.concatenate(x) for x in zip(*pairs))
    while True:
        least = np.minimum(label[left], label[right])
        if (least == label[left]).all() and (least == label[right]).all():
            return label
        for side in (left, right):
            np.minimum.at(label, label[side], least)
        while (label[label] != label).any():
            label = label[label]


def _cell_links(cell: np.ndarray, part: np.ndarray, fp: np.ndarray, distance: int) -> np.ndarray:
    """Labels within whole cells; rows are sorted by cell, and parts of a cell only meet each other
    where it has two."""
    n, table = len(cell), pivot_table(fp)
    ends = np.searchsorted(cell, cell, side="right")
    two = np.zeros(n, bool)
    if n:
        runs = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        mixed = np.minimum.reduceat(part, runs) != np.maximum.reduceat(part, runs)
        two = np.repeat(mixed, np.diff(np.append(runs, n)))
    label = np.arange(n)
    ahead = ends - np.arange(n) - 1
    at, begin = np.cumsum(ahead), 0
    while begin < n:  # rows whose pairs with later rows of the cell are looked at together
        done = at[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(at, done + PAIRS, side="right")))
        count = ahead[begin:stop]
        left = np.repeat(np.arange(begin, stop), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        meant = ~two[left] | (part[left] != part[right])
        found = close_pairs(fp, left[meant], right[meant], table, distance)
        if len(found[0]):
            label = forest(n, [found], label)
        begin = stop
    return label


def find_links(distance: int) -> Callable:
    """Over rows sorted by cell: links of a spanning forest of the pairs in each cell."""

    def links(held: pa.Table) -> pa.RecordBatch | None:
        key, a, b, part, fp = (held.column(c).to_numpy() for c in held.column_names)
        new = (np.diff(key, prepend=0) != 0) | (np.diff(a, prepend=0) != 0) | (np.diff(b, prepend=0) != 0)
        label = _cell_links(np.cumsum(new), part, fp.view(np.uint64), distance)
        hung = np.flatnonzero(label != np.arange(len(label)))
        return pa.record_batch([pa.array(fp[hung]), pa.array(fp[label[hung]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            edge = 0  # rows of this batch that still belong to the cell before
            if held:
                last = [held[-1].column(c)[-1].as_py() for c in ("key", "a", "b")]
                same = np.ones(batch.num_rows, bool)
                for c, x in zip(("key", "a", "b"), last):
                    same &= batch.column(c).to_numpy() == x
                edge = batch.num_rows if same.all() else int(np.argmin(same))
            held.append(batch.slice(0, edge))
            if edge < batch.num_rows:
                if sum(x.num_rows for x in held):
                    yield links(pa.Table.from_batches(held))
                # whole cells of this batch wait for what may follow the last of them
                held = [batch.slice(edge)]
        if held:
            yield links(pa.Table.from_batches(held))

    return run


def _links(prints: DataFrame, distance: int) -> DataFrame:
    """Links ``a, b`` between the fingerprints in ``prints`` that are within ``distance``."""
    prints.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    met = cells(nodes, distance).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")
    return met.mapInArrow(find_links(distance), "a long, b long")


def named(prints: DataFrame, links: DataFrame) -> DataFrame:
    """``fp, component_id`` of every fingerprint in ``prints`` (``doc_id, fp``)."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    hung = components(links).withColumnsRenamed({"id": "fp", "component_id": "root"})
    rooted = nodes.join(hung, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("node").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def _named(prints: DataFrame, distance: int) -> DataFrame:
    return named(prints, _links(prints, distance))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Documents are linked when their fingerprints differ in ``distance`` bits or fewer;
    ``component_id`` is the smallest ``doc_id`` reachable over links. Texts without words, null
    ones too, have the fingerprint zero and are linked like any other. Rows that share a
    ``doc_id`` are each reported. A null ``doc_id`` never names a component: that is null where no
    other document is in it. Other columns play no part.
    """
    prints = stage(fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    prints = prints.select("doc_id", "fp")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    joined = prints.join(_named(prints, distance), "fp", "left")
    return joined.select("doc_id", text.alias("fingerprint"), "component_id")


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns as one, so that new ones cannot clash with them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*(others or [F.lit(0)])).alias("_kept"))


def restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of what was :func:`carried`, in their order."""
    return rows.select(*[F.col(c if c in ("doc_id", "text") else f"_kept.`{c}`") for c in columns])


def representatives(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component, the one it is named after, all columns, of any names without a dot.

    Of rows that share that ``doc_id`` one stays. In components without any ``doc_id`` one document
    stays for each fingerprint. An empty table gives no rows.
    """
    printed = fingerprints(carried(docs), shingle).withColumn("_row", F.monotonically_increasing_id())
    printed = stage(printed, "fingerprints")  # written, so that row numbers stay as they are
    prints = printed.select("doc_id", "fp")
    return restored(one_each(printed, _named(prints, distance)), docs.columns)


def one_each(printed: DataFrame, names: DataFrame) -> DataFrame:
    """Of ``printed``, with ``_row`` and ``fp``, the rows that stay for the components in ``names``."""
    joined = printed.select("doc_id", "fp", "_row").join(names, "fp", "left")
    alone = F.when(F.col("component_id").isNull(), F.col("fp"))
    own = joined.filter(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    chosen = own.groupBy("component_id", alone).agg(F.min("_row").alias("_row")).select("_row")
    return printed.join(chosen, "_row", "left_semi")
