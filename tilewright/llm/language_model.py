"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling.

The word before a token is its context; before the first token of a text it is the end of a text. Every
context is a restaurant whose customers are the tokens seen there; its tables are customers of the
one parent restaurant that all contexts share, whose own base spreads evenly over the V words seen
and one for all others. There are as many restaurants as different words.

In a Chinese restaurant process only the number of tables per dish counts for predictions. A Gibbs
step draws it for one word in one restaurant, given all else: exactly, by generalised
Stirling numbers, up to EXACT customers; beyond, the customers are seated again one after the other,
those behind the first EXACT / 2 in runs of a 32nd of the seated ones, which share a
probability. The first sweep starts from one table
per pair, the seating of Kneser and Ney's counts; predictive probabilities are averaged over sweeps.

What is known lies in two tables of buckets. Pairs of word and context are dealt by the word's hash,
moved on by a 64th of the context's, so that the contexts of a frequent word spread over a 64th of all
buckets. Words are dealt by hash alone: their occurrences, tables in all contexts, tables in the
parent, and tables of all words in their own restaurant. In a sweep the buckets of pairs draw tables,
send sums per word to the buckets of words, and get the totals of their words and contexts back in the
same order; so the totals are those of the sweep before. Pairs seen once have one table for
certain: they are counted once and stay out of the sweeps. Counts leave a task once per pair. To score,
each group of documents asks for its different words and pairs once. All groups are scored, in up to
PASSES passes, so that the questions of one pass only are on disk at a time; shuffle files go when the
step that wrote them has ended. The driver sees sums over all buckets only. Words are told apart by 57
bits of a hash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm.groups import configure, group_documents, read_group
from tilewright.llm.words import Words, mix, pack, pack_sorted, unpack, unpack_sorted
from tilewright.staging import stage

BITS = 7
SWEEPS, EXACT = 2, 64
STRENGTH = 1.0
TEXT_BYTES, RUN_BYTES = 6 << 20, 1 << 19
LEAST_BUCKETS, BUCKET_BYTES = 32, 24 << 20
#: A context moves a pair by this share (2 ** -SPREAD) of all buckets; buckets of pairs to one of
#: words, and to one task; bytes of packed pairs that are merged at once, numbers worked on at once.
SPREAD, PER_WORDS, PER_TASK, FOLD_BYTES, SLICE = 6, 2, 1, 8 << 20, 1 << 17
#: Passes over the groups to be scored, groups that are worth a pass, bytes sent to Python at once.
PASSES, LEAST_GROUPS, BATCH_BYTES = 3, 8, 8 << 20
_END = mix(np.array([0x5EED], np.uint64))[0] >> np.uint64(BITS)
_KINDS = {"bucket": pa.int64(), "gid": pa.int64(), "blob": pa.binary(), "more": pa.binary(), "stats": pa.list_(pa.float64())}
_ROWS = "bucket long, gid long, blob binary, more binary, stats array<double>"
#: gid of a bucket's own rows, before what is sent to it: pairs seen once, which keep their one
#: table and stay out of the sweeps, and all else.
_LONE, _OWN = -2, -1


@contextmanager
def _frugal(spark: SparkSession) -> Iterator[None]:
    """Steps inside leave no shuffle files behind, and send rows of many megabytes a few at a time."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def held_out(ids: list) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids], bool)


def _different(values: np.ndarray) -> np.ndarray:
    """Ascending and once each, by sorting: ``np.unique`` hashes, at 20 times the cost for many different ones."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _placed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values, ascending, and where each value is among them: ``np.unique`` in half its memory."""
    order = np.argsort(values)
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    values, rank = values[new], np.cumsum(new)
    rank -= 1
    place = np.empty(len(rank), np.int64)
    place[order] = rank
    return values, place


def _runs(column: pa.Array) -> Iterator[pa.Array]:
    """Texts in runs of RUN_BYTES or more, for what takes many times their size on the way."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN_BYTES)) + 1
        yield column.slice(at, stop - at)
        at = stop


class Tokens:
    """Tokens of many texts: ``ids`` are the different words, ascending; of each token ``word`` and
    ``context`` are places in them, ``doc`` is its text. A text ends with a token of its own."""

    def __init__(self, column: pa.Array):
        hashes, docs, done = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for part in _runs(column):
            words = Words(part, lower=True)
            ends = words.first[1:]
            hashes.append(np.insert(words.hashes() >> np.uint64(BITS), ends, _END))
            docs.append(np.insert(words.doc, ends, np.arange(len(part))) + done)
            done += len(part)
        self.doc = np.concatenate(docs)
        self.ids, self.word = _placed(np.concatenate(hashes))
        self.context = np.zeros(len(self.word), np.int64)
        self.context[1:] = self.word[:-1]  # a text's last token is its end
        self.context[:1] = np.searchsorted(self.ids, _END)

    def codes(self) -> np.ndarray:
        return self.word * len(self.ids) + self.context


class Pairs:
    """Different pairs of tokens in order of bucket, word and context."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, buckets: int):
        word, context = codes // max(len(ids), 1), codes % max(len(ids), 1)
        share = _share(ids)
        route = share[word]
        route += share[context] >> np.uint64(SPREAD)
        route &= np.uint64(0xFFFFFFFF)
        route *= np.uint64(buckets)
        route >>= np.uint64(32)
        bucket = route.view(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.ids, self.bucket = ids, bucket[self.order]
        self.word, self.context = word[self.order], context[self.order]

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, slice]]:
        """Per bucket: its number, its ids, places of words and contexts in these, and which pairs."""
        begin = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        ends = np.append(begin[1:], len(self.bucket))
        i = 0
        while i < len(begin):  # runs of buckets with about SLICE pairs
            j = max(i + 1, int(np.searchsorted(ends, begin[i] + SLICE, "right")))
            yield from self._parts(begin[i:j], ends[i:j])
            i = j

    def _parts(self, begin: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        here, n, size = slice(begin[0], ends[-1]), ends[-1] - begin[0], max(len(self.ids), 1)
        base = self.bucket[here] * size
        held, place = np.unique(np.concatenate((base + self.word[here], base + self.context[here])), return_inverse=True)
        word, context = place[:n], place[n:]
        first = np.searchsorted(held, self.bucket[begin] * size)
        for a, b, i, j in zip(begin, ends, first, np.append(first[1:], len(held))):
            at = slice(a - here.start, b - here.start)
            yield int(self.bucket[a]), self.ids[held[i:j] % size], word[at] - i, context[at] - i, slice(a, b)


def _share(ids: np.ndarray) -> np.ndarray:
    """The upper 32 bits of what is known of the hashes."""
    return ids >> np.uint64(64 - BITS - 32)


def _cuts(ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words are ranges: which ones ascending ids fall into, and where each begins."""
    bucket = ((_share(ids) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[begin], begin


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= TEXT_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """Of ``bucket, gid, blob, more[, stats]``."""
    columns = zip(*((*r, None)[:5] for r in rows)) if rows else [[] for _ in _KINDS]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, _KINDS.values())], names=list(_KINDS))


def _matrix(columns: Sequence[np.ndarray]) -> bytes:
    """Packed by the slice: ``pack`` and ``unpack`` need some 50 bytes a number on the way."""
    return b"".join(pack(x[i : i + SLICE])[0].tobytes() for x in columns for i in range(0, len(x), SLICE))


def _count(data: bytes) -> int:
    raw = np.frombuffer(data, np.uint8)
    return sum(np.count_nonzero(raw[i : i + SLICE] < 128) for i in range(0, len(raw), SLICE))


def _numbers(data: bytes) -> np.ndarray:
    """What ``_matrix`` packed."""
    raw, out = np.frombuffer(data, np.uint8), np.empty(_count(data), np.int64)
    at = done = 0
    while at < len(raw):
        stop = at + SLICE
        stop += int((raw[stop - 1 : stop + 9] < 128).argmax()) if stop < len(raw) else 0  # ten bytes a number at most
        values = unpack(raw[at:stop])
        out[done : done + len(values)] = values
        at, done = stop, done + len(values)
    return out


def _columns(data: bytes, rows: int) -> list[np.ndarray]:
    return list(_numbers(data).reshape(-1, rows)) if rows else []


def _by_bucket(rows: DataFrame, tasks: int, function: Callable) -> DataFrame:
    """``function(bucket, rows)`` for every bucket, its own row first, then by ``gid``. One bucket is held at a time."""

    def run(batches):
        every = (row for batch in batches for row in batch.to_pylist())
        for bucket, held in groupby(every, key=lambda row: row["bucket"]):
            yield from function(bucket, held)

    return rows.repartition(tasks, "bucket").sortWithinPartitions("bucket", "gid").mapInArrow(run, _ROWS)


def send_counts(buckets: int) -> Callable:
    def run(batches):
        for table in _chunks(batches):
            tokens = Tokens(table.column("text").chunk(0))
            learn = ~held_out(table.column("doc_id").to_pylist())
            codes, counts = np.unique(tokens.codes()[learn[tokens.doc]], return_counts=True)
            pairs = Pairs(tokens.ids, codes, buckets)
            counts = counts[pairs.order]
            del table, tokens, codes
            yield _rows([
                (bucket, 0, pack_sorted(ids), _matrix([np.diff(word, prepend=0), context, counts[at]]))
                for bucket, ids, word, context, at in pairs.parts()
            ])

    return run


class Seats:
    """One bucket of pairs: places of words and contexts in ``ids``, customers, tables, and tables
    added up over samples."""

    def __init__(self, ids, word, context, counts, tables=None, drawn=None):
        self.ids, self.word, self.context, self.counts = ids, word, context, counts
        self.tables = np.ones(len(word), np.int64) if tables is None else tables
        self.drawn = np.zeros(len(word), np.int64) if drawn is None else drawn

    def only(self, mask: np.ndarray) -> Seats:
        word, context = self.word[mask], self.context[mask]
        held = np.zeros(len(self.ids), bool)
        held[word] = held[context] = True
        place = np.cumsum(held) - 1
        return Seats(self.ids[held], place[word], place[context], self.counts[mask])

    def rows(self, bucket: int) -> list[tuple]:
        lone = self.only(self.counts == 1)
        columns = [np.diff(lone.word, prepend=0), lone.context]
        first = bucket, _LONE, pack_sorted(lone.ids), _matrix(columns), [float(len(lone.word)), 0.0]
        del lone, columns
        return [first, self.only(self.counts > 1).row(bucket)]

    def row(self, bucket: int) -> tuple:
        columns = [np.diff(self.word, prepend=0), self.context, self.counts, self.tables, self.drawn]
        stats = [0.0, float((self.counts == 2).sum())]
        return bucket, _OWN, pack_sorted(self.ids), _matrix(columns), stats

    def sums(self) -> list[np.ndarray]:
        """Per id: tables of the word, tables in the context; occurrences and contexts of the word."""
        n = len(self.ids)
        each = [(self.word, self.tables), (self.context, self.tables), (self.word, self.counts), (self.word, None)]
        return [np.bincount(at, values, n).astype(np.int64) for at, values in each]


def read_seats(row: dict, samples: int = 0) -> Seats:
    """Of a bucket's own row; pairs seen once have drawn a table in each of ``samples``."""
    ids = unpack_sorted(row["blob"])
    if row["gid"] == _LONE:
        word, context = _numbers(row["more"]).reshape(2, -1)
        one, drawn = (np.broadcast_to(np.int64(x), len(word)) for x in (1, samples))
        return Seats(ids, np.cumsum(word), context, one, one, drawn)
    columns = _numbers(row["more"]).reshape(5, -1)
    return Seats(ids, np.cumsum(columns[0]), *columns[1:])


def _merged(ids: np.ndarray, codes: np.ndarray, counts: np.ndarray, told: list[tuple[np.ndarray, bytes, int]]):
    """Different pairs as ascending codes by places in ``ids``, and their counts, with what was ``told`` added."""
    every = _different(np.concatenate([ids, *(held for held, _, _ in told)]))
    place, done = np.searchsorted(every, ids), len(codes)
    keys, numbers = (np.empty(done + sum(n for _, _, n in told), np.int64) for _ in range(2))
    for i in range(0, done, SLICE):
        word, context = np.divmod(codes[i : min(i + SLICE, done)], len(ids))
        keys[i : i + len(word)] = place[word] * len(every) + place[context]
    numbers[:done] = counts
    for held, more, n in told:
        word, context, count = _numbers(more).reshape(3, n)
        place = np.searchsorted(every, held)
        keys[done : done + n] = place[np.cumsum(word)] * len(every) + place[context]
        numbers[done : done + n] = count
        done += n
    order = np.argsort(keys)
    keys = keys[order]
    numbers = numbers[order]
    begin = np.flatnonzero(np.diff(keys, prepend=-1))
    return every, keys[begin], np.add.reduceat(numbers, begin)


def merge_counts(bucket: int, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Counts of one bucket's pairs, held packed and added up by FOLD_BYTES."""
    merged, told, size = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
    for row in rows:
        told.append((unpack_sorted(row["blob"]), row["more"], _count(row["more"]) // 3))
        size += len(row["more"])
        if size > FOLD_BYTES:
            merged, told, size = _merged(*merged, told), [], 0
    if told:
        merged = _merged(*merged, told)
        told.clear()
    word, context = np.divmod(merged[1], len(merged[0]))
    seats = Seats(merged[0], word, context, merged[2])
    del merged, word, context
    yield _rows(seats.rows(bucket))


class Totals:
    """Sums over all buckets, and the discounts they suggest."""

    def __init__(self, stats: list[float], discounts: tuple[float, float]):
        self.words, self.learned, self.above, self.roots = stats[:4]
        self.discounts = discounts

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Predictive probability in the parent restaurant, for words of so many customers and tables."""
        d = self.discounts[1]
        new = (STRENGTH + d * self.roots) / (self.words + 1)
        return (customers - d * tables + new) / (STRENGTH + self.above)

    def back(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Weight of the parent in contexts of so many customers and tables."""
        return (STRENGTH + self.discounts[0] * tables) / (STRENGTH + customers)


def discount(once: float, twice: float) -> float:
    return min(max(once / (once + 2 * twice) if once else 0.5, 0.05), 0.95)


def _stirling(discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers S(c, t) up to EXACT."""
    out = np.full((EXACT + 1, EXACT + 2), -np.inf)
    out[1, 1] = 0
    t = np.arange(1, EXACT + 1)
    for c in range(1, EXACT):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(t <= c, np.log(np.maximum(c - discount * t, 1e-300)) + out[c, 1:-1], -np.inf)
        out[c + 1, 1:-1] = np.logaddexp(out[c, :-2], stay)
    return out


def draw_tables(counts, others, prior, discount: float, rng) -> np.ndarray:
    """Tables of dishes with so many customers, given the restaurant's other tables and the
    probability of the dish above."""
    tables = np.ones(len(counts), np.int64)
    stirling = _stirling(discount)
    order = np.argsort(counts, kind="stable")
    ends = np.searchsorted(counts[order], np.arange(EXACT + 2))
    for c in range(2, EXACT + 1):
        at = order[ends[c] : ends[c + 1]]
        for part in np.array_split(at, len(at) * c // (1 << 21) + 1) if len(at) else ():
            steps = STRENGTH + discount * (others[part][:, None] + np.arange(c))
            weight = np.cumsum(np.log(steps * prior[part][:, None]), axis=1) + stirling[c, 1 : c + 1]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            drawn = rng.random(len(part))[:, None] * weight[:, -1:]
            tables[part] = 1 + (weight[:, :-1] < drawn).sum(axis=1)
    many = order[ends[EXACT + 1] :]
    seated = np.ones(len(many), np.int64)
    while len(many):
        run = np.minimum(np.maximum(seated // 32, 1), counts[many] - seated)
        new = (STRENGTH + discount * (others[many] + tables[many])) * prior[many]
        tables[many] += rng.binomial(run, new / (new + seated - discount * tables[many]))
        seated = seated + run
        going = seated < counts[many]
        many, seated = many[going], seated[going]
    return tables


def tell(buckets: int, first: bool) -> Callable:
    """From buckets of pairs to those of words: sums per word, at first with occurrences and contexts."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                seats = read_seats(row)
                sums = seats.sums()[: 4 if first else 2]
                bucket, begin = _cuts(seats.ids, buckets)
                ends = np.append(begin[1:], len(seats.ids))
                gid = row["bucket"] if row["gid"] == _OWN else _LONE - 1 - row["bucket"]
                yield _rows([
                    (int(b), gid, pack_sorted(seats.ids[i:j]), _matrix([x[i:j] for x in sums]))
                    for b, i, j in zip(bucket, begin, ends)
                ])

    return run


def meet(number: int, totals: Totals | None) -> Callable:
    """In a bucket of words: adds up what the pairs tell, draws tables of the parent, and replies.

    A bucket's own row has per word its occurrences, tables in the parent, tables of pairs seen once by
    word and by context, and per sample the tables of the word, those in the parent, and those in its
    context.
    """

    def run(bucket: int, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        own, told = None, []
        for row in rows:
            ids = unpack_sorted(row["blob"])
            columns = _columns(row["more"], len(ids))
            if row["gid"] == _OWN:
                own = ids, columns
            else:
                told.append((row["gid"], ids, columns))
        every = own[0] if own else _different(np.concatenate([ids for _, ids, _ in told]))
        places = [np.searchsorted(every, ids) for _, ids, _ in told]
        sums, lone = np.zeros((2 if own else 4, len(every)), np.int64), np.zeros((2, len(every)), np.int64)
        for at, (gid, _, columns) in zip(places, told):
            sums[:, at] += columns
            if gid < _LONE:
                lone[:, at] += columns[:2]
        if own:
            sums += own[1][2:4]
        tables, inside = sums[:2]
        if own:
            kept = own[1]
            rng = np.random.default_rng([number, bucket])
            even = np.full(len(every), 1 / (totals.words + 1))
            roots = draw_tables(tables, totals.roots - kept[1], even, totals.discounts[1], rng)
            kept = [kept[0], roots, *kept[2:], tables, roots, inside]
            spread = np.zeros(0)
        else:
            roots = np.ones(len(every), np.int64)
            kept, spread = [sums[2], roots, *lone], sums[3]
        stats = [len(every), kept[0].sum(), tables.sum(), roots.sum(), (spread == 1).sum(), (spread == 2).sum()]
        yield _rows([(bucket, _OWN, pack_sorted(every), _matrix(kept), [float(x) for x in stats])])
        for at, (gid, _, _) in zip(places, told):
            if gid >= 0:  # to a bucket of pairs: bucket and gid change places
                yield _rows([(gid, bucket, None, _matrix([tables[at], roots[at], inside[at]]))])

    return run


def seat(number: int, totals: Totals) -> Callable:
    """One Gibbs sweep over a bucket of pairs, given what the buckets of words reply."""

    def run(bucket: int, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        seats, replies = None, []
        for row in rows:
            if row["gid"] == _OWN:
                seats = read_seats(row)
            else:
                replies.append(_numbers(row["more"]).reshape(3, -1))
        tables, roots, inside = np.concatenate([np.zeros((3, 0), np.int64), *replies], axis=1)
        prior = totals.parent(tables, roots)[seats.word]
        others = inside[seats.context] - seats.tables
        rng = np.random.default_rng([number, bucket, 1])
        seats.tables = draw_tables(seats.counts, others, prior, totals.discounts[0], rng)
        seats.drawn = seats.drawn + seats.tables
        yield _rows([seats.row(bucket)])

    return run


def _summed(rows: DataFrame, size: int) -> list[float]:
    """The sums of ``stats`` over all buckets, a few numbers."""
    each = [F.sum(F.element_at("stats", i + 1)).alias(f"s{i}") for i in range(size)]
    return [x or 0.0 for x in rows.filter("stats is not null").agg(*each).first()]


class Model:
    """The sampled seatings: buckets of pairs (``pairs``, and ``lone`` for those seen once), buckets of
    words, and the totals of each sample."""

    def __init__(self, pairs: DataFrame, lone: DataFrame, words: DataFrame, samples: list[Totals], buckets: int):
        self.pairs, self.lone, self.words, self.samples, self.buckets = pairs, lone, words, samples, buckets
        self.learned, self.distinct = int(samples[-1].learned), int(samples[-1].words)
        self.word_buckets, self.tasks = _dealt(buckets)


def _dealt(buckets: int) -> tuple[int, int]:
    return -(-buckets // PER_WORDS), -(-buckets // PER_TASK)


def learn(docs: DataFrame, sweeps: int = SWEEPS) -> Model:
    """Counts the training documents and samples ``sweeps`` seatings, from one table per pair on."""
    configure(docs.sparkSession)
    with _frugal(docs.sparkSession):
        return _learned(docs.select("doc_id", "text"), sweeps)


def _learned(docs: DataFrame, sweeps: int) -> Model:
    buckets = max(LEAST_BUCKETS, (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES)
    word_buckets, tasks = _dealt(buckets)
    pairs = stage(_by_bucket(docs.mapInArrow(send_counts(buckets), _ROWS), tasks, merge_counts), "pairs")
    told = pairs.mapInArrow(tell(word_buckets, True), _ROWS)
    met = stage(_by_bucket(told, tasks, meet(0, None)), "words")
    one, two = _summed(pairs, 2)
    *sums, lone, pair = _summed(met, 6)
    totals = Totals(sums, (discount(one, two), discount(lone, pair)))
    lone, pairs, samples = pairs.filter(F.col("gid") == _LONE), pairs.filter(F.col("gid") == _OWN), []
    for number in range(sweeps):
        replies = met.filter(F.col("gid") != _OWN)
        pairs = stage(_by_bucket(pairs.union(replies), tasks, seat(number, totals)), "pairs")
        told = pairs.mapInArrow(tell(word_buckets, False), _ROWS).union(met.filter(F.col("gid") == _OWN))
        met = stage(_by_bucket(told, tasks, meet(number, totals)), "words")
        totals = Totals(_summed(met, 4), totals.discounts)
        samples.append(totals)
    return Model(pairs, lone, met.filter(F.col("gid") == _OWN), samples, buckets)


def ask(buckets: int, word_buckets: int) -> Callable:
    """Of each group of documents, its different words (buckets from 0) and pairs (behind those)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(read_group(row["body"]).column("text"))
                bucket, begin = _cuts(tokens.ids, word_buckets)
                ends = np.append(begin[1:], len(tokens.ids))
                rows = [(int(b), row["gid"], pack_sorted(tokens.ids[i:j]), None) for b, i, j in zip(bucket, begin, ends)]
                pairs = Pairs(tokens.ids, _different(tokens.codes()), buckets)
                for b, ids, word, context, _ in pairs.parts():
                    asked = _matrix([np.diff(word, prepend=0), context])
                    rows.append((word_buckets + b, row["gid"], pack_sorted(ids), asked))
                yield _rows(rows)

    return run


def _places(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``asked`` are among ascending ``keys``, and which are there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def _fill(found: np.ndarray, keys: np.ndarray, values: Sequence[np.ndarray], asked: np.ndarray, known: np.ndarray) -> None:
    at, there = _places(keys, asked)
    there = there & known
    at = at[there]
    for column, numbers in zip(found, values):
        column[there] = numbers[at]


def answer(word_buckets: int, samples: int) -> Callable:
    """Per question, in its order: a word's occurrences and samples; customers and drawn tables of a pair.
    Zeros for what is unknown."""

    def run(bucket: int, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        keys, values, seats = np.zeros(0, np.uint64), np.zeros((1 + 3 * samples, 0), np.int64), []
        for row in rows:
            ids = unpack_sorted(row["blob"])
            if row["gid"] < 0:
                if bucket < word_buckets:
                    keys, values = ids, np.delete(np.array(_columns(row["more"], len(ids))), [1, 2, 3], axis=0)
                else:
                    x = read_seats(row, samples)
                    codes = x.word * len(x.ids)
                    codes += x.context
                    seats.append((x.ids, codes, (x.counts, x.drawn)))
                continue
            if bucket < word_buckets:
                found = np.zeros((len(values), len(ids)), np.int64)
                _fill(found, keys, values, ids, np.ones(len(ids), bool))
            else:
                word, context = _numbers(row["more"]).reshape(2, -1)
                word, found = np.cumsum(word), np.zeros((2, len(word)), np.int64)
                for held, codes, numbers in seats:
                    at, there = _places(held, ids)
                    _fill(found, codes, numbers, at[word] * len(held) + at[context], there[word] & there[context])
            yield _rows([(bucket, row["gid"], None, _matrix(list(found)))])

    return run


def _probabilities(word: list[np.ndarray], context: list[np.ndarray], pair: list[np.ndarray], samples: list[Totals]) -> np.ndarray:
    """Predictive probabilities averaged over samples, from what was answered about words (their own
    and their context's) and pairs."""
    customers, drawn = pair
    size = len(samples)
    own = (customers - samples[0].discounts[0] * drawn / size) / (STRENGTH + context[0])
    above = np.zeros(len(own))
    for i, totals in enumerate(samples):
        tables, roots = word[1 + 3 * i], word[2 + 3 * i]
        above += totals.parent(tables, roots) * totals.back(context[0], context[3 + 3 * i]) / size
    return own + above


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def evaluate(samples: list[Totals], buckets: int, norm: float) -> Callable:
    """Per group of documents, its texts and the answers: the sums of every document."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["bucket"])
        docs = read_group(rows[0]["blob"])
        tokens = Tokens(docs.column("text"))
        codes, pair = _placed(tokens.codes())
        del tokens.context
        pairs = Pairs(tokens.ids, codes, buckets)
        about, met, left = [], [], len(tokens.ids)
        for values in (_numbers(r["more"]) for r in rows[1:]):  # words first, then pairs
            if left:
                about.append(values.reshape(1 + 3 * len(samples), -1))
                left -= about[-1].shape[1]
            else:
                met.append(values.reshape(2, -1))
        about, met = np.concatenate(about, axis=1), np.concatenate(met, axis=1)
        p = np.empty(len(codes))
        for i in range(0, len(codes), SLICE):
            at = slice(i, i + SLICE)
            word, context = about[:, pairs.word[at]], about[:, pairs.context[at]]
            p[pairs.order[at]] = np.log10(_probabilities(list(word), list(context), list(met[:, at]), samples))
        n, size = about[0][tokens.word], docs.num_rows
        length = np.bincount(tokens.doc, minlength=size)
        base = np.bincount(tokens.doc, np.log10(n + 1), size) - length * norm
        score = np.bincount(tokens.doc, p[pair], size)
        ids = docs.column("doc_id").cast(pa.int64())
        columns = [ids, pa.array(held_out(ids.to_pylist())), pa.array(length, pa.int64()),
                   pa.array(np.bincount(tokens.doc, n > 0, size).astype(np.int64)), pa.array(base), pa.array(score)]
        yield pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Scores are log10 probabilities of whole texts; the perplexity is ``10 ** (-score / n_tokens)``.
    """
    with _frugal(docs.sparkSession):
        groups = group_documents(docs.select("doc_id", "text"), "texts", TEXT_BYTES)
        passes = min(PASSES, max(1, groups.select("gid").count() // LEAST_GROUPS))
        turn = F.pmod(F.xxhash64("gid"), F.lit(passes))
        done = [stage(_scored(groups.filter(turn == i), model), "scores") for i in range(passes)]
    learned = F.lit(model.learned).cast("long").alias("train_tokens")
    return reduce(DataFrame.union, done).select("doc_id", "held_out", "n_tokens", "n_known", learned, "base_score", "score")


def _scored(groups: DataFrame, model: Model) -> DataFrame:
    """The sums of every document of some groups, asked of the whole model."""
    asked = groups.mapInArrow(ask(model.buckets, model.word_buckets), _ROWS)
    behind = model.pairs.union(model.lone).withColumn("bucket", F.col("bucket") + F.lit(model.word_buckets))
    rows = asked.union(model.words).union(behind)
    found = _by_bucket(rows, 2 * model.tasks, answer(model.word_buckets, len(model.samples)))
    texts = groups.select(F.lit(-1).cast("long").alias("bucket"), "gid", F.col("body").alias("blob"), F.lit(None).cast("binary").alias("more"))
    norm = math.log10(model.learned + model.distinct + 1)
    met = texts.union(found.select("bucket", "gid", "blob", "more")).groupBy("gid")
    return met.applyInArrow(evaluate(model.samples, model.buckets, norm), _SCORES)


def scores(docs: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """Learns from documents whose crc32 of the id leaves another remainder than 2 by 7, scores all.

    A null text is empty: one token, its end. A null ``doc_id`` is not held out. Rows that share a
    ``doc_id`` are scored each for itself. Without training documents every token has
    probability 1 over all unknown words, and scores are 0. Other columns play no part.
    """
    return score(docs, learn(docs, sweeps))
