"""Best-fit packing by minimum bin slack.

A document is one piece; only a longer one is cut, into whole sequences and a rest. Sequences are
filled one after the other: the longest piece left goes in, and a subset-sum program over the
lengths left (one bit per reachable sum, a shift per length and power of two of its copies) finds the
fullest combination beside it, which is then removed. The same combination stays the fullest as
long as its lengths last, so it is removed as often as it can be at once. All this needs of the
corpus is how many pieces there are of each length, ``length`` numbers whatever its size; it runs
on the driver. Pieces are ranked within their length as a distributed job, and a combination
takes a range of ranks.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.groups import configure
from tilewright.llm.words import word_lists
from tilewright.operators.numbering import number_rows
from tilewright.staging import stage

LENGTH, END = 2048, 0
VOCABULARY = "word_bpe_49k"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Words and pieces of words whose ids a worker keeps, the longest of them in bytes, words at once.
KNOWN_WORDS, KNOWN_BYTES, WORDS_AT_ONCE = 1 << 19, 64, 1 << 16
# Printable ASCII and Latin letters with accents, which no normal form changes, and how
# the vocabulary cuts them (lower case).
_EASY = re.compile(rb"(?:[\n!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^\na-z0-9ß-öø-ÿ]+")


@cache
def _tokenizer(vocabulary: str):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
    return Tokenizer.from_file(public.path(f"{vocabulary}.json"))


@cache
def _merges(vocabulary: str):
    """The tokenizer's merges alone, for pieces that are in lower case and cut already."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

    merges = Tokenizer(_tokenizer(vocabulary).model)
    merges.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    return merges


class Ids:
    """Ids of texts as bytes of unsigned 32-bit numbers.

    The vocabulary drops white space and joins nothing across it, so a text's ids are those of its
    words, one after the other; a word is encoded once as long as it is kept. Words of plain
    characters are cut here and their pieces kept, too; all others, and words that may hold a
    special token, go through the whole tokenizer.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        self.whole, self.merges = _tokenizer(vocabulary), _merges(vocabulary)
        self.known, self.pieces = {}, {"\n": b""}
        vocabulary = self.merges.get_vocab()  # the last id of a piece ends it
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, words: list[bytes]) -> None:
        joined, others = b"\n".join(words), []
        if not _EASY.fullmatch(joined) or b"<|" in joined:
            easy = [bool(_EASY.fullmatch(w)) and b"<|" not in w for w in words]
            others = [w for w, plain in zip(words, easy) if not plain]
            words = [w for w, plain in zip(words, easy) if plain]
            joined = b"\n".join(words)
        for word, found in zip(others, self.whole.encode_batch([w.decode() for w in others], add_special_tokens=False)):
            self.known[word] = np.asarray(found.ids, "<u4").tobytes()
        if not words:
            return
        cut = _PIECES.findall(joined.decode().lower())
        new = list({p for p in cut if p not in self.pieces})
        if new:
            (encoded,) = self.merges.encode_batch_fast([" ".join(new)], add_special_tokens=False)
            found = np.asarray(encoded.ids, "<u4")
            ends, raw = (4 * (np.flatnonzero(self.last[found]) + 1)).tolist(), found.tobytes()
            self.pieces.update((p, raw[a:b]) for p, a, b in zip(new, [0, *ends], ends))
        ids = [*map(self.pieces.__getitem__, cut), b""]
        begin = 0
        for word, end in zip(words, [i for i, p in enumerate([*cut, "\n"]) if p == "\n"]):
            self.known[word] = ids[begin] if end == begin + 1 else b"".join(ids[begin:end])
            begin = end + 1
        for piece in new:
            if len(piece) > KNOWN_BYTES:
                del self.pieces[piece]

    def _encode(self, held: list[tuple[int, list[bytes]]], out: list[list[bytes]]) -> None:
        known = self.known
        new = list({w for _, words in held for w in words if w not in known})
        if new:
            self._learn(new)
        for i, words in held:
            out[i].append(b"".join(map(known.__getitem__, words)))
        for word in new:
            if len(word) > KNOWN_BYTES:
                del known[word]
        if len(known) > KNOWN_WORDS or len(self.pieces) > KNOWN_WORDS:
            self.known, self.pieces = {}, {"\n": b""}

    def of(self, texts: list[str]) -> list[bytes]:
        out, held, many = [[] for _ in texts], [], 0
        for i, text in enumerate(texts):
            for words in word_lists(text.encode()):
                held.append((i, words))
                many += len(words)
                if many >= WORDS_AT_ONCE:
                    self._encode(held, out)
                    held, many = [], 0
        self._encode(held, out)
        return [b"".join(parts) for parts in out]


@cache
def _ids(vocabulary: str) -> Ids:
    return Ids(vocabulary)


def cut(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of every document's ids and END; only documents longer than ``length`` have several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = _ids(vocabulary), np.array([END], "<u4").tobytes()
        for batch in batches:
            out = [[] for _ in range(5)]
            found = ids.of([text or "" for text in batch.column("text").to_pylist()])
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), found):
                raw = memoryview(body + end)
                for piece, at in enumerate(range(0, len(raw), 4 * length)):
                    own = raw[at : at + 4 * length]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=names)

    configure(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """The longest length left and the fullest combination beside it, as ``{length: how often}``.

    Of equally full ones it is the one reached first by taking long lengths before short ones.
    """
    longest = int(np.flatnonzero(counts)[-1])
    room -= longest
    inside, reach, steps = (1 << room + 1) - 1, 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, take = min(int(counts[length]) - (length == longest), room // length), 1
        while left > 0 and not reach >> room:
            take = min(take, left)
            fresh = reach << take * length & inside & ~reach
            steps.append((length, take, fresh))
            reach |= fresh
            left -= take
            take *= 2
        if reach >> room:
            break
    chosen, total = {longest: 1}, reach.bit_length() - 1
    for length, take, fresh in reversed(steps):
        if fresh >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


def combinations(counts: np.ndarray, room: int) -> list[tuple[dict[int, int], int]]:
    """Combinations and how often each fills a sequence, until no piece is left."""
    counts, out = counts.copy(), []
    while counts.any():
        chosen = fullest(counts, room)
        times = min(int(counts[length]) // many for length, many in chosen.items())
        for length, many in chosen.items():
            counts[length] -= many * times
        out.append((chosen, times))
    return out


def places(plan: list[tuple[dict[int, int], int]], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Ranges of ranks over all lengths one after the other, in ascending order.

    Range i begins at rank ``low[i]``; its pieces go to the sequences from ``sequence[i]`` on,
    ``each[i]`` to one, from ``offset[i]`` on.
    """
    taken = np.cumsum(counts) - counts
    rows, sequence = [], 0
    for chosen, times in plan:
        offset = 0
        for length, many in chosen.items():
            rows.append((taken[length], sequence, many, offset))
            taken[length] += many * times
            offset += many * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("low", "sequence", "each", "offset"), table.T))


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``; sequences are numbered from 0.

    A null text is empty and has one token, END; a null ``doc_id`` ranks first; rows sharing a
    ``doc_id`` are packed each for itself; pieces of equal length rank by ``doc_id`` and ``piece``.
    An empty table gives no rows; other columns play no part.
    """
    pieces = stage(cut(docs, length, vocabulary), "pieces")
    counts = np.zeros(length + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # one row per length
        counts[row["length"]] = row["count"]
    table, before = places(combinations(counts, length), counts), np.cumsum(counts) - counts
    ranked = number_rows(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = before[size] + batch.column("rank").to_numpy() - 1
            own = np.searchsorted(table["low"], rank, "right") - 1
            nth = rank - table["low"][own]
            sequence = table["sequence"][own] + nth // table["each"][own]
            offset = table["offset"][own] + nth % table["each"][own] * size
            columns = [*batch.columns[:-1], pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
