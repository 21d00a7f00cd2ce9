"""Exact repeats of word sequences between documents.

A *window* is ``window`` consecutive words of one document. Every word covered by a window whose
word sequence also starts in a document with a smaller ``doc_id`` is marked. Which windows are
compared at all is left to a *selection*: it names the shorter word sequences, seeds, of a
group of documents, and the windows that stand on a given set of seeds. Two windows of equal words
always share a seed, so only windows on a seed that occurs in several groups are gathered:

1. per group, its distinct seeds go to buckets by hash, packed as sorted differences;
2. per bucket, seeds of several groups are found by sorting and comparing neighbours, and told
   to these groups;
3. per group, the windows extending such seeds go to buckets with the smallest ``doc_id``
   of each; per bucket the smallest over all groups is found and told to the other groups;
4. per group, words of windows that have a smaller ``doc_id`` are marked.

A sequence occurs once per group at most in what is shuffled, so copies, however many, weigh no
more than the groups they stand in, and never meet as pairs. Hashes have 64 bits.

Null texts have no words; a null ``doc_id`` sorts after all others; rows sharing a ``doc_id`` are
kept apart and are not repeats of each other (but what a row repeats of itself in several
groups is the same document, too).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.groups import attach, bucket_count, group_documents, read_group
from tilewright.llm.words import Words, pack, pack_sorted, unpack, unpack_sorted

_LAST = np.iinfo(np.int64).max
BLOBS = "bucket long, gid long, blob binary, more binary"
GROUPS = ("gid", "body", "blobs")
TOLD = "gid long, blob binary, more binary"


def rows(*columns: list) -> pa.RecordBatch:
    """A batch of the columns of BLOBS or TOLD: numbers first, then two of bytes."""
    names = ["bucket", "gid", "blob", "more"][4 - len(columns) :]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()][4 - len(columns) :]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def by_bucket(gid: int, hashes: np.ndarray, extra: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Distinct hashes with a small number each, as one row per bucket."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    bucket, hashes, extra = bucket[order], hashes[order] // np.uint64(buckets), extra[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    blobs = [pack_sorted(x) for x in np.split(hashes, cuts[1:])] if len(cuts) else []
    more = [pack(x)[0].tobytes() for x in np.split(extra, cuts[1:])] if len(cuts) else []
    return rows(bucket[cuts].tolist(), [gid] * len(cuts), blobs, more)


def told(blobs: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """What buckets have told a group: hashes in ascending order, and a number for each.

    The first packed number of ``more`` is the bucket, the second the number of buckets.
    """
    hashes, extra = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for x in blobs or []:
        values = unpack(x["more"])
        hashes.append(unpack_sorted(x["blob"]) * values[1] + values[0])
        extra.append(values[2:])
    hashes, extra = np.concatenate(hashes), np.concatenate(extra)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], extra[order]


def within(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Whether each value is among the ascending ones."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def smallest(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the smallest document of each, and the place of each input there."""
    order = np.argsort(hashes, kind="stable")
    new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order][:1]))
    place = np.empty(len(hashes), np.int64)
    place[order] = np.cumsum(np.bincount(new, minlength=len(hashes))) - 1
    least = np.minimum.reduceat(docs[order], new) if len(new) else docs[:0]
    return hashes[order][new], least, place


def gather(batches: Iterator[pa.RecordBatch]) -> tuple[list, list, list]:
    """Of one bucket: the groups, and of each its hashes in ascending order and their numbers."""
    gids, hashes, extra = [], [], []
    for batch in batches:
        for gid, blob, more in zip(*(batch.column(c).to_pylist() for c in ("gid", "blob", "more"))):
            gids.append(gid)
            hashes.append(unpack_sorted(blob))
            extra.append(unpack(more))
    return gids, hashes, extra


def _tell(key, gids, hashes, extra, keep, buckets) -> Iterator[pa.RecordBatch]:
    """Rows for the groups: of each, the kept hashes with their numbers."""
    at = 0
    out: tuple[list, list, list] = ([], [], [])
    for gid, own in zip(gids, hashes):
        mine = keep[at : at + len(own)]
        if mine.any():
            head = np.array([key, buckets], np.uint64)
            values = np.concatenate((head, extra[at : at + len(own)][mine]))
            for column, x in zip(out, (gid, pack_sorted(own[mine]), pack(values)[0].tobytes())):
                column.append(x)
        at += len(own)
    if out[0]:
        yield rows(*out)


def shared_seeds(buckets: int) -> Callable:
    """Per bucket: seeds that occur in several groups, and in one of them as a reference."""

    def reduce(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gids, hashes, extra = gather(batches)
        h, reference = np.concatenate(hashes), np.concatenate(extra)
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(np.diff(h[order], prepend=~h[order][:1]))
        counts = np.diff(np.append(new, len(h)))
        good = (counts > 1) & (np.add.reduceat(reference[order], new) > 0)
        keep = np.empty(len(h), bool)
        keep[order] = np.repeat(good, counts)
        yield from _tell(key[0].as_py(), gids, hashes, np.zeros(len(h), np.uint64), keep, buckets)

    return reduce


def first_documents(buckets: int, base: int) -> Callable:
    """Per bucket: the smallest document of each window, told to groups without it."""

    def reduce(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gids, hashes, extra = gather(batches)
        h, docs = np.concatenate(hashes), np.concatenate(extra)
        _, least, place = smallest(h, docs)
        keep = least[place] < docs
        yield from _tell(key[0].as_py(), gids, hashes, least[place], keep, buckets)

    return reduce


def send_seeds(selection, buckets: int, bits: int) -> Callable:
    def run(batches):
        for batch in batches:
            for gid, body in zip(*(batch.column(c).to_pylist() for c in ("gid", "body"))):
                words = Words(read_group(body).column("text"))
                seeds, reference = selection.seeds(words)
                seeds >>= np.uint64(64 - bits)
                distinct, _, place = smallest(seeds, np.zeros(len(seeds), np.int64))
                marked = np.zeros(len(distinct), np.uint64)
                marked[place[reference]] = 1
                yield by_bucket(gid, distinct, marked, buckets)

    return run


def send_windows(selection, buckets: int, bits: int, base: int) -> Callable:
    def run(batches):
        for batch in batches:
            for gid, body, blobs in zip(*(batch.column(c).to_pylist() for c in GROUPS)):
                if not blobs:
                    continue
                group = read_group(body)
                words = Words(group.column("text"))
                seeds, _ = told(blobs)
                windows, within_one = words.grams(words.hashes(), selection.window)
                wanted = np.flatnonzero(selection.windows(words, seeds, bits) & within_one)
                docs = doc_ids(group)[words.doc[wanted]]
                distinct, least, _ = smallest(windows[wanted], docs)
                yield by_bucket(gid, distinct, (least - base).astype(np.uint64), buckets)

    return run


def covered(group: pa.RecordBatch, words: Words, window: int, blobs: list | None, base: int) -> np.ndarray:
    """The words of a group to be removed."""
    windows, within_one = words.grams(words.hashes(), window)
    at = np.flatnonzero(within_one)
    cover = np.zeros(len(words) + 1, np.int64)
    if len(at):
        windows, docs = windows[at], doc_ids(group)[words.doc[at]]
        distinct, least, place = smallest(windows, docs)
        known, first = told(blobs)
        known_at = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
        if len(known):
            there = known[known_at] == distinct
            least = np.where(there, np.minimum(least, first[known_at].astype(np.int64) + base), least)
        repeated = at[least[place] < docs]
        cover[repeated] += 1
        np.subtract.at(cover, repeated + window, 1)
    return np.cumsum(cover)[:-1] > 0


def with_repeats(docs: DataFrame, selection, name: str) -> tuple[DataFrame, int]:
    """Groups ``(gid, body, blobs)`` from which :func:`covered` finds the words to remove."""
    found = docs.agg(F.min("doc_id"), F.sum(F.octet_length("text"))).first()
    base, size = found[0] or 0, found[1] or 0
    buckets = bucket_count(size)
    bits = min(64, max(32, math.ceil(math.log2(size + 1)) + 6))
    groups = group_documents(docs, name)
    seeds = groups.mapInArrow(send_seeds(selection, buckets, bits), BLOBS)
    shared = seeds.groupBy("bucket").applyInArrow(shared_seeds(buckets), TOLD)
    windows = attach(groups, shared).mapInArrow(send_windows(selection, buckets, bits, base), BLOBS)
    firsts = windows.groupBy("bucket").applyInArrow(first_documents(buckets, base), TOLD)
    return attach(groups, firsts), base


def _kept(group: pa.RecordBatch, words: Words, gone: np.ndarray) -> Iterator[tuple[int, int, list[bytes]]]:
    """Per document: its number of words, how many go, and the kept ones."""
    raw = words.data.tobytes()
    for d in range(group.num_rows):
        a, b = words.first[d], words.first[d + 1]
        all_words = raw[words.bounds[d] : words.bounds[d + 1]].split()
        lost = gone[a:b]
        n = int(lost.sum())
        yield len(all_words), n, [w for w, x in zip(all_words, lost) if not x] if n else all_words


def digest(groups: DataFrame, window: int, base: int) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256`` of the kept words joined by spaces."""

    def run(batches):
        for batch in batches:
            for body, blobs in zip(*(batch.column(c).to_pylist() for c in GROUPS[1:])):
                group = read_group(body)
                words = Words(group.column("text"))
                gone = covered(group, words, window, blobs, base)
                found = [
                    (n, lost, hashlib.sha256(b" ".join(kept)).hexdigest())
                    for n, lost, kept in _kept(group, words, gone)
                ]
                n, lost, sha = zip(*found)
                yield pa.record_batch(
                    [group.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(lost, pa.int64()), pa.array(sha)],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return groups.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def rewrite(groups: DataFrame, schema: T.StructType, window: int, base: int) -> DataFrame:
    """The documents without the marked words; texts that lose none stay as they are.

    A run of marked words goes together with the white space behind it.
    """
    columns = schema.names

    def run(batches):
        for batch in batches:
            for body, blobs in zip(*(batch.column(c).to_pylist() for c in GROUPS[1:])):
                group = read_group(body)
                words = Words(group.column("text"))
                gone = covered(group, words, window, blobs, base)
                texts = group.column("text").to_pylist()
                raw = words.data.tobytes()
                for d in np.unique(words.doc[gone]):
                    a, b = words.first[d], words.first[d + 1]
                    edges = np.flatnonzero(np.diff(gone[a:b], prepend=False, append=False)) + a
                    at, kept = words.bounds[d], []
                    for begin, end in edges.reshape(-1, 2):
                        kept.append(raw[at : words.starts[begin]])
                        at = words.starts[end] if end < b else words.bounds[d + 1]
                    texts[d] = b"".join([*kept, raw[at : words.bounds[d + 1]]]).decode()
                arrays = [
                    pa.array(texts, pa.string()) if c == "text" else group.column(c) for c in columns
                ]
                yield pa.record_batch(arrays, names=columns)

    return groups.mapInArrow(run, schema)
