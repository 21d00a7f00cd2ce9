"""What filters remove, lose and share, in every order they could be applied in.

A document has a set of filters that it fails. An order removes it at the first of them, so with
the failing sets as a matrix of 0 (fails) and infinity (passes), and the place of each filter in
each order as another one (the inverse permutations), the step at which an order removes a set is
their min-plus product: the minimum over filters of the sum. Documents enter only as counts per
failing set and part; the product has one row per set and one column per order, whatever the
corpus, and the counts are scattered to the steps it names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.llm.groups import configure
from tilewright.llm.words import word_lists
from tilewright.staging import stage

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 100, 80, 10
COPY = 1 << FILTERS.index("E")
# Fixed values of the filters C and D.
_UPPER, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
JUDGED = "doc_id long, part string, fails int, content binary"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def failing(text: str) -> int:
    """The filters A to D that a text fails, as bits."""
    raw = text.encode()
    words, distinct = 0, set()
    for some in word_lists(raw):
        words += len(some)
        distinct.update(some)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    flags = (
        words < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT * words,
        100 * upper > MOST_UPPER * len(text),
        len(raw.translate(None, _MARKS)) < len(raw),
    )
    return sum(flag << i for i, flag in enumerate(flags))


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id, part, fails, content``: failed filters among A to D, and a SHA-256 of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            fails = pa.array([failing(t) for t in texts], pa.int32())
            content = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), batch.column("part"), fails, content], names=["doc_id", "part", "fails", "content"])

    configure(docs.sparkSession)
    part = F.coalesce(F.col("lang"), F.lit("")).alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, "text").mapInArrow(run, JUDGED)


def failing_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, n, good, toxic``: documents per part and set of failed filters, E included.

    Copies are counted, not joined back: rows of one text and id fall together first, then those of
    one text and part with the smallest id beside them, and only these meet per text.
    """
    judged = stage(judge(docs), "judged")
    each = judged.groupBy("content", "part", "fails", "doc_id").agg(F.count("*").alias("n"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("_toxic"),
    )
    # null ids match nothing; the salt spreads them
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("content")).otherwise(0)
    same = (F.col("doc_id") == F.col("_doc")) & (F.col("salt") == F.col("_salt"))
    marked = each.withColumn("salt", salt).join(marks.withColumn("_salt", F.lit(0).cast("long")), same, "left")
    for name in ("good", "toxic"):
        marked = marked.withColumn(name, F.col("n") * F.coalesce(F.col(f"_{name}"), F.lit(0)))
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "n", "good", "toxic")).alias("first")
    texts = marked.groupBy("content", "part", "fails").agg(*sums, first)
    # one row per part of a text
    smallest = F.min(F.struct("first.last", "first.doc_id")).over(W.partitionBy("content"))
    texts = texts.withColumn("smallest", smallest)
    is_first = F.col("first.doc_id").eqNullSafe(F.col("smallest.doc_id"))
    own = [F.when(is_first, F.col(f"first.{c}")).otherwise(0).alias(c) for c in ("n", "good", "toxic")]
    copies = [(F.col(c) - F.when(is_first, F.col(f"first.{c}")).otherwise(0)).alias(c) for c in ("n", "good", "toxic")]
    sets = F.array(F.struct("fails", *own), F.struct(F.col("fails").bitwiseOR(F.lit(COPY)).alias("fails"), *copies))
    return texts.select("part", F.inline(sets)).groupBy("part", "fails").agg(*sums)


def removal_steps() -> tuple[list[str], np.ndarray, np.ndarray]:
    """Orders, place of each filter in each (filter by order), step at which each removes each set.

    Steps count from 1; one beyond the last means that the set is kept.
    """
    k = len(FILTERS)
    orders = np.array([*permutations(range(k))])
    places = np.argsort(orders, axis=1).T + 1
    fails = np.arange(1 << k)[:, None] >> np.arange(k) & 1
    masks = np.where(fails, 0, k + 1)
    steps = np.minimum((masks[:, :, None] + places[None]).min(axis=1), k + 1)
    return ["".join(FILTERS[f] for f in order) for order in orders], places, steps


def _audit(part: pd.DataFrame) -> pd.DataFrame:
    """All orders of one part, from its counts per failing set (at most 32 rows)."""
    names, places, steps = removal_steps()
    k, m = len(FILTERS), len(names)
    sets = part["fails"].to_numpy()
    steps, fails = steps[sets], (sets[:, None] >> np.arange(k) & 1).astype(bool)
    column = np.broadcast_to(np.arange(m), steps.shape)

    def scattered(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((m, k + 2), np.int64)
        np.add.at(out, (column, steps), np.broadcast_to(weights[:, None], steps.shape))
        return out[:, 1 : k + 1]

    n = part["n"].to_numpy(np.int64)
    removed = scattered(n)
    order = np.argsort(places, axis=0).T  # order by step: its filter
    redundant = np.zeros((m, k), np.int64)
    for f in range(k):  # sets failing f that are gone before its place
        gone = fails[:, f, None] & (steps < places[f])
        redundant[np.arange(m), places[f] - 1] = (n[:, None] * gone).sum(axis=0)
    alone = np.array([n[sets == 1 << f].sum() for f in range(k)])
    worth = np.array([removed[np.arange(m), places[f] - 1].sum() for f in range(k)])
    columns = {
        "kept": n.sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": alone[order],
        "good_lost": scattered(part["good"].to_numpy(np.int64)),
        "toxic_lost": scattered(part["toxic"].to_numpy(np.int64)),
        "shapley": worth[order],
    }
    out = {"part": part["part"].iloc[0], "filter_order": np.repeat(names, k), "step": np.tile(np.arange(1, k + 1), m)}
    return pd.DataFrame(out | {c: v.ravel() for c, v in columns.items()})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with document counts.

    A null text is empty, a null ``lang`` the part ``''``. A null ``doc_id`` counts as larger than
    all others: it is a copy of any row with an id and the same text, and it has no label. Rows
    sharing a ``doc_id`` are counted each for itself and are no copies of one another. A document
    is good or toxic if any row of ``labels`` says so. An empty table gives no rows; other columns
    play no part.
    """
    return failing_sets(docs, labels).groupBy("part").applyInPandas(_audit, AUDIT)


ORACLE = r"""
with docs as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
counted as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
           min(doc_id) over (partition by text) as smallest
    from docs),
marks as (
    select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic
    from labels where doc_id is not null group by doc_id),
flags as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           len(words) < 100 as a,
           100 * len(list_distinct(words)) < 80 * len(words) as b,
           100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as c,
           regexp_matches(text, '[#$%&*|]') as d,
           coalesce(smallest < coalesce(c.doc_id, 9223372036854775807), false) as e
    from counted c left join marks m on c.doc_id = m.doc_id),
sets as (
    select part, a, b, c, d, e, count(*) as n, sum(good) as good, sum(toxic) as toxic
    from flags group by part, a, b, c, d, e),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
    select u.f || v.f || w.f || x.f || y.f as filter_order
    from letters u, letters v, letters w, letters x, letters y
    where len(list_distinct([u.f, v.f, w.f, x.f, y.f])) = 5),
gone as (
    select part, filter_order, n, good, toxic, fails, len(fails) as many,
           coalesce(list_min([instr(filter_order, f) for f in fails]), 6) as step
    from (select *, list_filter([case when a then 'A' end, case when b then 'B' end, case when c then 'C' end,
                                 case when d then 'D' end, case when e then 'E' end], lambda x: x is not null) as fails
          from sets), orders),
steps as (select part, filter_order, unnest([1, 2, 3, 4, 5])::int as step from (select distinct part from docs), orders),
counts as (
    select s.part, s.filter_order, s.step, s.filter_order[s.step] as f,
           sum(case when g.step > s.step then n else 0 end)::bigint as kept,
           sum(case when g.step = s.step then n else 0 end)::bigint as removed,
           sum(case when g.step < s.step and list_contains(fails, s.filter_order[s.step]) then n else 0 end)::bigint as redundant,
           sum(case when many = 1 and list_contains(fails, s.filter_order[s.step]) then n else 0 end)::bigint as unique_fails,
           sum(case when g.step = s.step then good else 0 end)::bigint as good_lost,
           sum(case when g.step = s.step then toxic else 0 end)::bigint as toxic_lost
    from steps s join gone g on s.part = g.part and s.filter_order = g.filter_order
    group by s.part, s.filter_order, s.step)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, f))::bigint as shapley
from counts
"""
