"""Suffix-array deduplication on sparse suffixes.

Of all suffixes (the words of a document from one position on) only those at minimiser positions
are kept: in every run of ``window`` words, the position whose ``prefix`` words have the smallest
hash. The choice depends on the words alone, so equal runs keep the same suffix. Kept suffixes
are sorted by their prefixes and neighbours compared; equal ones are extended to the left and to
the right, as far as the run of ``window`` words chosen by them goes, and the union of equal
runs is the maximal repeat (see :mod:`tilewright.llm.repeats`).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tilewright.llm import repeats
from tilewright.llm.words import Words

#: Words of the shortest repeat that goes, and of the prefixes that are sorted.
WINDOW, PREFIX = 50, 10


@dataclass(frozen=True)
class SparseSuffixes:
    window: int = WINDOW
    prefix: int = PREFIX

    def _chosen(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all prefixes, and the position chosen in the window from each position on."""
        hashes, _ = words.grams(words.hashes(), self.prefix)
        n, span = len(words) - self.window + 1, self.window - self.prefix + 1
        if n <= 0:
            return hashes, np.zeros(0, np.int64)
        best, width = np.arange(len(hashes)), 1
        while 2 * width <= span:
            best = self._less(hashes, best[:-width], best[width:])
            width *= 2
        rest = span - width
        return hashes, self._less(hashes, best[:n], best[rest : rest + n])

    @staticmethod
    def _less(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(hashes[right] < hashes[left], right, left)

    def _within_one(self, words: Words, n: int) -> np.ndarray:
        return words.doc[:n] == words.doc[self.window - 1 :][:n]

    def seeds(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Prefix hashes at minimiser positions; each stands for its suffix."""
        hashes, chosen = self._chosen(words)
        at = np.unique(chosen[self._within_one(words, len(chosen))])
        return hashes[at], np.ones(len(at), bool)

    def windows(self, words: Words, seeds: np.ndarray, bits: int) -> np.ndarray:
        """Windows whose minimiser is among the seeds."""
        hashes, chosen = self._chosen(words)
        return repeats.within(hashes[chosen] >> np.uint64(64 - bits), seeds)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` after removing repeats of earlier documents.

    ``docs`` needs ``doc_id`` and ``text``; other columns play no part. See
    :mod:`tilewright.llm.repeats` for nulls and repeated ids. An empty table gives no rows.
    """
    groups, base = repeats.with_repeats(docs.select("doc_id", "text"), SparseSuffixes(window), "suffixes")
    return repeats.digest(groups, window, base)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents themselves, all columns, with the repeats cut out of ``text``."""
    groups, base = repeats.with_repeats(docs, SparseSuffixes(window), "suffixes")
    return repeats.rewrite(groups, docs.schema, window, base)
