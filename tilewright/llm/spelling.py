"""Spelling variants by a dictionary of pairs of trie nodes.

The words form two tries, one read forwards and one backwards, whose nodes are numbered: a node of
the first stands for a prefix, one of the second for a suffix. A word is the pair (prefix, suffix)
at every gap between its characters, and at every character it is the pair around it, the
character skipped. Two words differ by one replaced character exactly if they share a skipped
pair, and by one inserted character exactly if a gap pair of the shorter one is a skipped pair of
the longer one; so near words are what integer joins find, and nothing has to be verified. Words
under one skipped pair differ in one character only, so they are no more than the alphabet has.

A trie is numbered from the sorted words: a word adds the nodes that its predecessor does not
share. Sorted ranges of words are numbered independently. What a range shares with earlier ones it
shares with the last word before it, so nodes on the way to a range's last word have numbers that
every range can tell from the list of last words; all others are counted.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.groups import configure
from tilewright.staging import stage

LEAST_LENGTH, LEAST_COUNT, RATIO, TYPO_EVERY = 6, 5, 5, 199
# Fixed value: what words are made of.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Counts that a task holds before it hands them on, in words and code points.
HELD_WORDS, HELD_POINTS = 1 << 18, 1 << 23
#: Code points of the words in one range of a trie.
RANGE_POINTS = 1 << 19
_ON_THE_WAY = 1 << 31
NODES = "id long, word string, n long, nodes array<long>"
GAP, SKIP, REPEATED = 0, 1, 2


def run_counts(doc_id: int | None, text: str | None) -> Counter:
    """The words of one text after deletions, those shorter than LEAST_LENGTH left out."""
    found, out = Counter(RUN.findall((text or "").encode().translate(_LOWER).decode())), Counter()
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in found.items():
        if len(word) < LEAST_LENGTH:
            continue
        h = zlib.crc32(word.encode(), seed)
        if h % TYPO_EVERY == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= LEAST_LENGTH:
            out[word] += n
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over all whole texts, for words that occur LEAST_COUNT times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, points = Counter(), 0

        def row() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = run_counts(doc_id, text)
                points += sum(len(w) for w in own if w not in held)
                held.update(own)
                if len(held) > HELD_WORDS or points > HELD_POINTS:
                    yield row()
                    held, points = Counter(), 0
        yield row()

    configure(docs.sparkSession)
    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def common(a: str, b: str) -> int:
    """How many code points two words share at the beginning."""
    return sum(1 for _ in takewhile(lambda pair: pair[0] == pair[1], zip(a, b)))


def shared_nodes(lasts: list[str], part: int) -> list[int]:
    """Numbers of the nodes on the way to the last word before a range, from the root on.

    A node belongs to the first of the ranges whose last words, up to that one, all lie below it.
    """
    if not part:
        return [0]
    word, out = lasts[part - 1], []
    depth, owner = len(word), part - 1
    for earlier in range(part - 2, -2, -1):
        same = min(depth, common(word, lasts[earlier])) if earlier >= 0 else 0
        out += [owner << 32 | _ON_THE_WAY | k for k in range(depth, same, -1)]
        depth, owner = same, earlier
        if not depth:
            break
    return [0, *out[::-1]]


def trie_paths(words: list[str], lasts: list[str], part: int) -> Iterator[list[int]]:
    """For each of the sorted words of a range, the nodes from the root to it."""
    shared = shared_nodes(lasts, part)
    before, way, path, counted = lasts[part - 1] if part else "", lasts[part], [0], 1
    previous = ""
    for word in words:
        kept = common(word, previous)
        path = path[: kept + 1]
        from_earlier, on_the_way = common(word, before), common(word, way)
        for k in range(kept + 1, len(word) + 1):
            if k <= from_earlier:
                path.append(shared[k])
            elif k <= on_the_way:
                path.append(part << 32 | _ON_THE_WAY | k)
            else:
                path.append(part << 32 | counted)
                counted += 1
        yield path
        previous = word


def number_trie(words: DataFrame, backwards: bool = False) -> DataFrame:
    """``id, word, n, nodes``: the trie nodes of every word, read forwards or backwards.

    ``words`` are distinct. Without an ``id`` they get one, ascending in code point order.
    """
    key = F.reverse("word") if backwards else F.col("word")
    points = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    ranges = words.withColumn("key", key).repartitionByRange(points // RANGE_POINTS + 1, "key")
    ranges = stage(ranges.withColumn("part", F.spark_partition_id()), "trie-ranges")
    # one word per range
    last = {r["part"]: r["last"] for r in ranges.groupBy("part").agg(F.max("key").alias("last")).collect()}
    order = {part: i for i, part in enumerate(sorted(last))}
    lasts = [last[part] for part in sorted(last)]

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        part = order[table.column("part")[0].as_py()]
        ids = table.column("id") if backwards else pa.array((part << 32) + np.arange(table.num_rows))
        nodes = pa.array(trie_paths(table.column("key").to_pylist(), lasts, part), pa.list_(pa.int64()))
        return pa.table({"id": ids, "word": table.column("word"), "n": table.column("n"), "nodes": nodes})

    return ranges.groupBy("part").applyInArrow(number, NODES)


def node_pairs(words: DataFrame) -> DataFrame:
    """``prefix, suffix, kind, id, n``: every gap and every skipped character of every word.

    Skipping any character of a run of equal ones leaves the same text; all but the first such
    are REPEATED, which tells replaced characters but not inserted ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, suffix, kind, sizes = [], [], [], []
            for word, front, back in zip(*(batch.column(c).to_pylist() for c in ("word", "front", "back"))):
                n, back = len(word), back[::-1]
                prefix += front + front[:-1]
                suffix += back + back[1:]
                kind += [GAP] * (n + 1)
                kind += [REPEATED if i and word[i] == word[i - 1] else SKIP for i in range(n)]
                sizes.append(2 * n + 1)
            sizes = np.array(sizes, np.int64)
            own = [pa.array(np.repeat(batch.column(c).to_numpy(), sizes)) for c in ("id", "n")]
            columns = [pa.array(prefix, pa.int64()), pa.array(suffix, pa.int64()), pa.array(kind, pa.int32()), *own]
            yield pa.record_batch(columns, names=["prefix", "suffix", "kind", "id", "n"])

    return words.mapInArrow(run, "prefix long, suffix long, kind int, id long, n long")


def near_words(front: DataFrame) -> DataFrame:
    """``id, near, near_n``: every word with each word one character away, in both directions.

    ``front`` has the words with their nodes read forwards.
    """
    back = number_trie(front.select("id", "word", "n"), backwards=True)
    both = front.withColumnRenamed("nodes", "front").join(back.select("id", F.col("nodes").alias("back")), "id")
    pairs = stage(node_pairs(both), "node-pairs")
    place = ["prefix", "suffix"]
    skipped = pairs.filter(F.col("kind") != GAP)
    other = skipped.select(*place, "kind", F.col("id").alias("near"), F.col("n").alias("near_n"))
    replaced = skipped.join(other, place).filter("id != near")
    inserted = pairs.filter(F.col("kind") == GAP).join(other.filter(F.col("kind") == SKIP), place)
    longer = inserted.select("id", "near", "near_n")
    shorter = inserted.select(F.col("near").alias("id"), F.col("id").alias("near"), F.col("n").alias("near_n"))
    return replaced.select("id", "near", "near_n").unionByName(longer).unionByName(shorter)


def follow(forms: DataFrame, most: int) -> DataFrame:
    """``id, root``: where the chains of ``id, form`` end.

    A form occurs RATIO times as often as its word, so a chain is no longer than the logarithm of
    the largest count, and doubling the steps ends in a few rounds.
    """
    steps = max(1, int(math.log(max(most, 1), RATIO)))
    jumps = stage(forms.select("id", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(steps))):
        on = jumps.select(F.col("id").alias("root"), F.col("root").alias("_on"))
        jumps = stage(jumps.join(on, "root", "left").select("id", F.coalesce("_on", "root").alias("root")), "forms")
    return jumps


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word; see the module for what is near.

    A null text has no words; a null ``doc_id`` is written as an empty text in the hash that
    deletes characters; rows sharing a ``doc_id`` and repeated rows count each for itself. Of near
    words with equal counts the first in code point order is the form. A table without words
    that occur often enough gives no rows; other columns play no part.
    """
    front = stage(number_trie(stage(count_words(docs), "words")), "trie")
    known, near = front.select("id", "word", "n"), near_words(front)
    best = F.struct("near_n", (-F.col("near")).alias("earlier"))
    found = near.groupBy("id").agg(
        F.count("*").alias("n_near"), F.max_by("near", best).alias("form"), F.max("near_n").alias("form_n")
    )
    joined = stage(known.join(found, "id", "left"), "near-words")
    formed = joined.filter(F.col("form_n") >= RATIO * F.col("n"))
    most = joined.agg(F.max("n")).first()[0] or 0
    ends = formed.select("id", "form", "form_n").join(follow(formed, most), "id")
    for name in ("form", "root"):
        named = known.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
        ends = ends.join(named, name)
    out = joined.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near")).join(
        ends.select("id", "form_word", "root_word", "form_n"), "id", "left"
    )
    return out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
