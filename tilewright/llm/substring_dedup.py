"""Substring deduplication by fixed-block anchors.

The reference side of every document is cut into blocks of ``block`` words that do not overlap;
the blocks are indexed by hash. Every rolling run of ``block`` words of every document probes that
index. A repeat of ``window`` words holds a whole reference block when ``2 * block <= window + 1``,
so no repeat is missed. Hits are extended: the windows that contain them are compared as a whole,
and the union of equal windows is the maximal exact repeat (see :mod:`tilewright.llm.repeats`).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tilewright.llm import repeats
from tilewright.llm.words import Words

WINDOW = 13


@dataclass(frozen=True)
class FixedBlocks:
    window: int = WINDOW

    @property
    def block(self) -> int:
        return (self.window + 1) // 2

    def seeds(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all rolling runs, and which of them are reference blocks."""
        runs, within_one = words.grams(words.hashes(), self.block)
        place = np.arange(len(runs)) - words.first[words.doc[: len(runs)]]
        return runs[within_one], (place % self.block == 0)[within_one]

    def windows(self, words: Words, seeds: np.ndarray, bits: int) -> np.ndarray:
        """Windows that contain a run among the seeds."""
        runs, _ = words.grams(words.hashes(), self.block)
        hit = repeats.within(runs >> np.uint64(64 - bits), seeds)
        n = len(words) - self.window + 1
        if n <= 0:
            return np.zeros(0, bool)
        found = np.zeros(n, bool)
        for offset in range(self.window - self.block + 1):
            found |= hit[offset : offset + n]
        return found


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` after removing repeats of earlier documents.

    ``docs`` needs ``doc_id`` and ``text``; other columns play no part. See
    :mod:`tilewright.llm.repeats` for nulls and repeated ids. An empty table gives no rows.
    """
    groups, base = repeats.with_repeats(docs.select("doc_id", "text"), FixedBlocks(window), "blocks")
    return repeats.digest(groups, window, base)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents themselves, all columns, with the repeats cut out of ``text``."""
    groups, base = repeats.with_repeats(docs, FixedBlocks(window), "blocks")
    return repeats.rewrite(groups, docs.schema, window, base)
