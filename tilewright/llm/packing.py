"""Packing token sequences by cutting-stock column generation.

Every document is cut into pieces of ``length`` tokens, one of half that if the rest has so many,
and a rest; so rests are short enough to fill sequences well. What is left to decide is which of
them share a sequence. They are counted by class (length in units of UNIT, rounded up), and a
linear program covers the histogram with as few patterns (multisets of classes that fit into one
sequence) as possible. Its columns are generated: the dual prices of the classes go into a knapsack
solved by dynamic programming, which either finds a pattern worth more than a sequence or proves
the optimum. The solution is rounded down; first-fit decreasing places the few rests this leaves
over. The histogram has ``length / UNIT`` classes whatever the corpus, so the program is
solved on the driver; the pieces are ranked within their class as a distributed job, and a
pattern takes a range of ranks.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.groups import configure
from tilewright.llm.words import Words, span_hashes
from tilewright.operators.numbering import number_rows
from tilewright.staging import stage

LENGTH, UNIT, END = 1024, 4, 0
VOCABULARY = "byte_bpe_50k"
TEXT_BYTES = 4 << 20
#: The program ends at the optimum, at this relative distance from it, or after so many columns.
GAP, COLUMNS = 1e-4, 4000
# White space beyond the six bytes that part words, and texts of special tokens: such texts are
# tokenized as a whole.
_WHOLE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|<\\|endoftext\\|>"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@cache
def _tokenizer(vocabulary: str):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(f"{vocabulary}.json"))


@cache
def _encoding(vocabulary: str):
    """The same vocabulary by ranks, and the bytes of each id."""
    import public_tokenizers as public
    import tiktoken

    with open(public.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    encoding = tiktoken.Encoding(
        vocabulary, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding, sizes


def _gather(values: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[b:b + n] one after the other."""
    places = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return values[places]


def token_ids(column: pa.Array, vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and how many each text has.

    The pattern that splits texts never joins a word with white space behind it, so a word with
    the white space before it always has the same ids. Each different one is encoded once.
    """
    column = column.fill_null("")
    encoding, sizes = _encoding(vocabulary)
    words = Words(column)
    docs, many = len(column), np.diff(words.first)
    # one stretch per word, from the end of the word before, and one for white space at the end
    first = np.zeros(len(words), bool)
    first[words.first[:-1][many > 0]] = True
    begins = np.where(first, words.bounds[words.doc], np.roll(words.ends, 1))
    last = np.where(many > 0, words.ends[words.first[1:] - 1] if len(words) else 0, words.bounds[:-1])
    tails = np.flatnonzero(last < words.bounds[1:])
    spaced = begins < words.starts
    alone = np.flatnonzero(~spaced)
    raw = words.data.tobytes()
    # different spaced words, encoded as one text
    at = np.flatnonzero(spaced)
    _, index, inverse = np.unique(
        span_hashes(words.data, begins[at], words.ends[at]), return_index=True, return_inverse=True
    )
    spans = [raw[a:b] for a, b in zip(begins[at[index]].tolist(), words.ends[at[index]].tolist())]
    ids = np.asarray(encoding.encode_ordinary(b"".join(spans).decode()), np.int64)
    ends = np.cumsum(np.fromiter(map(len, spans), np.int64, len(spans)))
    cuts = np.searchsorted(np.cumsum(sizes[ids]), ends, side="left") + 1 if len(ids) else ends
    tables, offset = [ids], len(ids)
    span_begin, span_count = np.concatenate(([0], cuts[:-1]))[: len(cuts)], np.diff(cuts, prepend=0)
    begin, count = np.zeros(len(words) + len(tails), np.int64), np.zeros(len(words) + len(tails), np.int64)
    begin[at], count[at] = span_begin[inverse], span_count[inverse]
    others = [*zip(alone, begins[alone], words.ends[alone])]
    others += [*zip(len(words) + np.arange(len(tails)), last[tails], words.bounds[1:][tails])]
    for place, a, b in others:
        own = np.asarray(encoding.encode_ordinary(raw[a:b].decode()), np.int64)
        begin[place], count[place] = offset, len(own)
        tables.append(own)
        offset += len(own)
    order = np.argsort(np.concatenate((words.doc, tails)), kind="stable")
    doc = np.concatenate((words.doc, tails))[order]
    begin, count = begin[order], count[order]
    table = np.concatenate(tables)
    whole = np.flatnonzero(pc.match_substring_regex(column, _WHOLE).to_numpy(zero_copy_only=False))
    if len(whole):  # replace what the stretches of these texts stand for
        keep = ~np.isin(doc, whole)
        doc, begin, count = doc[keep], begin[keep], count[keep]
        exact = [np.asarray(_tokenizer(vocabulary).encode(column[int(d)].as_py(), add_special_tokens=False).ids, np.int64) for d in whole]
        lengths = np.array([len(x) for x in exact])
        place = np.searchsorted(doc, whole)
        doc = np.insert(doc, place, whole)
        begin = np.insert(begin, place, len(table) + np.cumsum(lengths) - lengths)
        count = np.insert(count, place, lengths)
        table = np.concatenate((table, *exact))
    return _gather(table, begin, count), np.bincount(doc, count, docs).astype(np.int64)


def cut(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of every document's ids and END: ``length`` long, then half of that, then the rest."""
    half = length // 2

    def pieces(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        texts = table.column("text").chunk(0)
        ids, counts = token_ids(texts, vocabulary)
        totals = counts + 1
        ends = np.cumsum(totals)
        full = np.full(int(totals.sum()), END, "<u4")
        mask = np.ones(len(full), bool)
        mask[ends - 1] = False
        full[mask] = ids
        whole, rest = np.divmod(totals, length)
        many = whole + (rest >= half) + (rest % half > 0)
        doc = np.repeat(np.arange(len(totals)), many)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        start = np.minimum(place, whole[doc]) * length + np.maximum(place - whole[doc], 0) * half
        size = np.where(place < whole[doc], length, np.minimum(totals[doc] - start, half))
        begin = (ends - totals)[doc] + start
        raw = memoryview(full.tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + size).tolist())]
        arrays = [table.column("doc_id").chunk(0).cast(pa.int64()).take(pa.array(doc)), start, size, crc, totals[doc]]
        return pa.record_batch([pa.array(x, pa.int64()) for x in arrays], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= TEXT_BYTES:
                yield pieces(held)
                held, size = [], 0
        if held:
            yield pieces(held)

    configure(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def _best_pattern(prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of classes 1..len(prices) of at most ``room`` units, by knapsack."""
    sizes = np.arange(1, len(prices) + 1)
    value, choice = np.zeros(room + 1), np.zeros(room + 1, int)
    for r in range(1, room + 1):
        fits = sizes[:r]
        options = value[r - fits] + prices[: len(fits)]
        k = int(np.argmax(options))
        if options[k] > value[r - 1] + 1e-12:
            value[r], choice[r] = options[k], k + 1
        else:
            value[r] = value[r - 1]
    pattern, r = np.zeros(len(prices), int), room
    while r > 0:
        if choice[r]:
            pattern[choice[r] - 1] += 1
            r -= choice[r]
        else:
            r -= 1
    return value[room], pattern


def patterns(demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of classes 1..room and how often each is used, covering the demand exactly."""
    present = np.flatnonzero(demand)
    if not len(present):
        return []
    m = len(present)
    columns = np.diag(room // (present + 1)).astype(float)  # patterns of the basis
    inverse, use = np.diag(1 / np.diag(columns)), demand[present] / np.diag(columns)
    for _ in range(COLUMNS):
        dual = inverse.sum(axis=0)
        prices = np.zeros(room)
        prices[present] = np.maximum(dual, 0)
        worth, pattern = _best_pattern(prices, room)
        if worth <= 1 + GAP:  # sequences needed are at least the dual value over worth
            break
        entering = pattern[present].astype(float)
        direction = inverse @ entering
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        step = ratio[leave]
        use = np.maximum(use - step * direction, 0)
        use[leave] = step
        columns[:, leave] = entering
        inverse[leave] /= direction[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(direction[others], inverse[leave])
    left = demand.astype(np.int64).copy()
    out = []
    for k in range(m):
        pattern = np.zeros(room, np.int64)
        pattern[present] = np.round(columns[:, k]).astype(np.int64)
        held = pattern > 0
        times = min(int(np.floor(use[k] + 1e-9)), int((left[held] // pattern[held]).min()) if held.any() else 0)
        if times > 0:
            out.append((pattern, times))
            left -= times * pattern
    bins: list[list] = []  # first-fit decreasing over what rounding left
    for c in np.flatnonzero(left)[::-1]:
        for _ in range(int(left[c])):
            home = next((b for b in bins if b[0] >= c + 1), None)
            if home is None:
                bins.append(home := [room, np.zeros(room, np.int64)])
            home[0] -= c + 1
            home[1][c] += 1
    return out + [(pattern, 1) for _, pattern in bins]


def slots(plan: list[tuple[np.ndarray, int]]) -> dict[int, list[tuple]]:
    """Per class, ranges of ranks ``(low, high, first sequence, per sequence, first slot)``."""
    taken: dict[int, int] = {}
    out: dict[int, list[tuple]] = {}
    sequence = 0
    for pattern, times in plan:
        slot = 0
        for c in np.flatnonzero(pattern)[::-1].tolist():
            each = int(pattern[c])
            low = taken.get(c + 1, 0)
            taken[c + 1] = low + each * times
            out.setdefault(c + 1, []).append((low, low + each * times, sequence, each, slot))
            slot += each
        sequence += times
    return out


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``; sequences are numbered from 0.

    A null text is empty and has one token, END; a null ``doc_id`` ranks first; rows sharing a
    ``doc_id`` are packed each for itself. Other columns play no part.
    """
    pieces = stage(cut(docs, length, vocabulary), "pieces")
    classed = pieces.withColumn("class", F.ceil(F.col("length") / UNIT).cast("int"))
    demand = np.zeros(length // UNIT, np.int64)
    for row in classed.groupBy("class").count().collect():  # one row per class
        demand[row["class"] - 1] = row["count"]
    found = slots(patterns(demand, length // UNIT))
    ranges = "array<struct<low:bigint,high:bigint,sequence:bigint,each:bigint,slot:bigint>>"
    table = docs.sparkSession.createDataFrame([*found.items()], f"class int, ranges {ranges}")
    ranked = number_rows(classed, ["class"], ["doc_id", "start", "ids_crc32", "doc_tokens"], "rank")
    # at most length / UNIT rows, and no more ranges than patterns have classes
    placed = ranked.withColumn("rank", F.col("rank") - 1).join(F.broadcast(table), "class")
    own = F.filter("ranges", lambda x: (x["low"] <= F.col("rank")) & (F.col("rank") < x["high"]))[0]
    placed = placed.withColumn("own", own).withColumn("at", F.col("rank") - F.col("own.low"))
    placed = placed.withColumn("sequence_id", F.expr("own.sequence + at div own.each"))
    placed = placed.withColumn("slot", F.expr("own.slot + at % own.each"))
    before = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint").alias("offset")
    return placed.select(*pieces.columns, "sequence_id", offset)
