"""Quality by pairwise preferences: a Bradley-Terry model over features of texts.

A document labelled good is preferred to one labelled bad. Scores are linear in the features, and
the probability of a preference is the logistic function of the score difference; the weights
minimise the logistic loss of feature differences over such pairs. A quantile of the scores is the
threshold, and scores are mapped to 0 to 1 so that the threshold falls on CUT.

The model is fitted on all labelled rows. Their features are written in groups of about GROUP rows
that have rows of both kinds; every row is in at least one pair of its group. A Newton step is one pass
over the groups, and sums of the features' number squared, one set per task, are all that reaches the
driver. The quantile is found in sorted ranges of all scores. Features look at whole texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.llm.groups import configure
from tilewright.llm.words import Words, mix
from tilewright.staging import stage

#: Preference pairs that are drawn at least, and cut of the score.
PAIRS, CUT = 200_000, 0.7
#: Rows of a group of pairs, and rows of the rarer kind that it should have.
GROUP, RARER = 2_000, 100
RIDGE, STEPS = 1e-3, 25


def _kinds() -> dict[str, np.ndarray]:
    table = {}
    for name, chosen in {
        "upper": range(65, 91), "digit": range(48, 58), "high": range(128, 256), "line": [10],
        "stop": [46], "comma": [44], "shout": [33, 63],
        "symbol": [*range(34, 44), 45, 47, *range(58, 63), 64, *range(91, 97), *range(123, 127)],
    }.items():
        table[name] = np.zeros(256, bool)
        table[name][list(chosen)] = True
    return table


_KINDS = _kinds()
_MARKS = _KINDS["symbol"] | _KINDS["shout"]


def _variety(keys: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the share of distinct keys and the share of the commonest one."""
    own = mix(keys + mix(doc.astype(np.uint64) + np.uint64(1)))
    _, at, count = np.unique(own, return_index=True, return_counts=True)
    most = np.zeros(docs)
    np.maximum.at(most, doc[at], count)
    total = np.maximum(np.bincount(doc, minlength=docs), 1)
    return np.bincount(doc[at], minlength=docs) / total, most / total


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers per text, all zero but for a flag where there are no words."""
    words = Words(column)
    docs, n = len(column), np.diff(words.first)
    some, size = np.maximum(n, 1), np.maximum(np.diff(words.bounds), 1)
    out = [np.log1p(n), (n == 0), np.minimum(n, 3) / 3]
    for table in _KINDS.values():
        sums = np.concatenate(([0], np.cumsum(table[words.data])))
        share = np.diff(sums[words.bounds]) / size
        out += [share, np.sqrt(share)]
    length = (words.ends - words.starts).astype(float)
    mean = np.bincount(words.doc, length, docs) / some
    spread = np.bincount(words.doc, length**2, docs) / some - mean**2
    out += [np.log1p(mean), np.log1p(np.maximum(spread, 0))]
    hashes = words.hashes()
    same = np.zeros(len(words), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    out.append(np.bincount(words.doc, same, docs) / some)
    lower = Words(column, lower=True).hashes()
    for k in (1, 3, 8):
        keys, within_one = words.grams(lower, k)
        distinct, most = _variety(keys[within_one], words.doc[: len(keys)][within_one], docs)
        out += [distinct, distinct * np.log1p(n), most]
    marked = _MARKS[words.data[words.ends - 1]] if len(words) else np.zeros(0, bool)
    out.append(np.bincount(words.doc, marked, docs) / some)
    alone = length == 1
    out.append(np.bincount(words.doc, alone, docs) / some)
    return np.column_stack([np.asarray(x, float) for x in out]) if docs else np.zeros((0, 0))


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores in 0 to 1; CUT is the threshold."""
        z = np.clip(((x - self.centre) / self.scale) @ self.weights - self.threshold, -60, 60)
        half = 2 / (1 + np.exp(-z))
        return np.where(z >= 0, CUT + (1 - CUT) * (half - 1), CUT * half)


def _rows(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, function: Callable) -> np.ndarray | None:
    """The sum of what ``function`` makes of each batch, an array; one per task reaches the driver."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                found = function(batch)
                total = found if total is None else total + found
        if total is not None:
            yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = [np.array(r["sums"]) for r in rows.mapInArrow(run, "sums array<double>").collect()]
    return np.sum(parts, axis=0) if parts else None


def _groups(rows: DataFrame, n: int, n_good: int) -> DataFrame:
    """``number, good, bad``: the rows dealt over groups, their features as bytes per kind.

    Rows of the rarer kind are repeated in as many groups as it takes for each to have some.
    """
    parts, rarer = -(-n // GROUP), min(n_good, n - n_good)
    copies = min(parts, max(1, -(-RARER * parts // rarer)))
    is_rarer = F.col("good") == F.lit(n_good <= n - n_good)
    places = F.sequence(F.lit(0), F.when(is_rarer, F.lit(copies - 1)).otherwise(F.lit(0)))
    dealt = rows.select("good", "x", F.xxhash64("doc_id", "x").alias("at"), F.explode(places).alias("place"))
    dealt = dealt.select("good", "x", F.pmod(F.col("at") + F.col("place"), F.lit(parts)).alias("number"))

    def run(table: pa.Table) -> pa.Table:
        x = _rows(table.column("x").combine_chunks())
        x, good = x[order := np.lexsort(x.T)], table.column("good").to_numpy()[order]
        number = table.column("number").slice(0, 1).combine_chunks()
        kinds = [pa.array([x[good == kind].tobytes()], pa.binary()) for kind in (True, False)]
        return pa.table([number, *kinds], names=["number", "good", "bad"])

    return dealt.groupBy("number").applyInArrow(run, "number long, good binary, bad binary")


def _differences(number: int, good: np.ndarray, bad: np.ndarray, times: int) -> np.ndarray:
    """Feature differences of the pairs of a group; each row is in ``times`` or more."""
    if not len(good) or not len(bad):
        return np.zeros((0, good.shape[1]))
    rng, count = np.random.default_rng(number), times * max(len(good), len(bad))
    up, down = (
        np.concatenate([rng.permutation(len(side)) for _ in range(-(-count // len(side)))])[:count] for side in (good, bad)
    )
    return good[up] - bad[down]


def _threshold(scores: DataFrame) -> float:
    """Between which scores to cut, so that fewest ``good`` are below and fewest others above.

    Each sorted range of ``score, good`` gives its ends and its best cut; only these are compared.
    """

    def run(batches):
        held = [(b.column("score").to_numpy(), b.column("good").to_numpy()) for b in batches if b.num_rows]
        if held:
            score, gain = (np.concatenate(c) for c in zip(*held))
            cost, last = np.cumsum(gain), np.append(score[1:] != score[:-1], True)
            k = int(np.argmin(np.where(last, cost, np.inf)))
            after = float(score[k + 1]) if k + 1 < len(score) else None
            row = [float(score[0]), float(score[-1]), int(cost[-1]), int(cost[k]), float(score[k]), after]
            yield pa.record_batch([pa.array([v]) for v in row], names=[f.name for f in schema.fields])

    kinds = {"low": T.DoubleType(), "high": T.DoubleType(), "total": T.LongType(), "best": T.LongType(),
             "at": T.DoubleType(), "after": T.DoubleType()}
    schema = T.StructType([T.StructField(n, t) for n, t in kinds.items()])
    counted = scores.groupBy("score").agg(F.sum(F.when(F.col("good"), 1).otherwise(-1)).alias("good"))
    ranges = sorted(counted.repartitionByRange("score").sortWithinPartitions("score").mapInArrow(run, schema).collect())
    least, cut, below = 0, ranges[0]["low"] - 0.5, 0
    for r, following in zip(ranges, [*ranges[1:], None]):
        if below + r["best"] < least:
            after = r["after"] if r["after"] is not None else following["low"] if following else r["high"] + 1
            least, cut = below + r["best"], (r["at"] + after) / 2
        below += r["total"]
    return cut


def fit(rows: DataFrame) -> Model:
    """Newton steps on the logistic loss of feature differences, then the best quantile.

    ``rows`` is a table of ``doc_id, good, x``, read once per step. Without labels of both kinds every
    score is CUT.
    """

    def totals(batch):
        x, good = _rows(batch.column("x")), batch.column("good").to_numpy(zero_copy_only=False)
        return np.concatenate(([len(x), good.sum()], x.sum(axis=0)))

    sums = _summed(rows, totals)
    n, n_good = (0, 0) if sums is None else (int(v) for v in sums[:2])
    if n_good in (0, n):
        width = len(features(pa.array([""]))[0])
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    centre = sums[2:] / n
    scale = np.sqrt(_summed(rows, lambda batch: ((_rows(batch.column("x")) - centre) ** 2).sum(axis=0)) / n)
    scale[scale <= 1e-12 * np.abs(centre)] = 1
    width, times = len(centre), max(1, -(-PAIRS // max(n_good, n - n_good)))
    groups = stage(_groups(rows, n, n_good), "preferences")
    weights = np.zeros(width)

    def step(batch):
        out = np.zeros(1 + width + width * width)
        for number, *sides in zip(*(c.to_pylist() for c in batch.columns)):
            good, bad = ((np.frombuffer(side).reshape(-1, width) - centre) / scale for side in sides)
            difference = _differences(number, good, bad, times)
            p = 1 / (1 + np.exp(np.clip(difference @ weights, -60, 60)))  # of the wrong order
            curve = (difference * (p * (1 - p))[:, None]).T @ difference
            out += np.concatenate(([len(p)], difference.T @ p, curve.ravel()))
        return out

    for _ in range(STEPS):
        sums = _summed(groups.select("number", "good", "bad"), step)
        pairs, gradient, curve = sums[0], sums[1 : 1 + width], sums[1 + width :].reshape(width, width)
        change = np.linalg.solve(curve / pairs + RIDGE * np.eye(width), gradient / pairs - RIDGE * weights)
        weights = weights + change
        if np.abs(change).max() < 1e-6:
            break

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                z = ((_rows(batch.column("x")) - centre) / scale) @ weights
                yield pa.record_batch([pa.array(z), batch.column("good")], names=["score", "good"])

    return Model(centre, scale, weights, _threshold(rows.select("x", "good").mapInArrow(score, "score double, good boolean")))


def _held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on all labelled documents whose crc32 of the id leaves another remainder than 2 by 4.

    Of several labels of a document the smallest counts; null labels and ids do not count. Labels meet
    the features, not the texts.
    """
    configure(docs.sparkSession)
    known = labels.filter("doc_id is not null and quality is not null").filter(~_held_out())
    known = known.groupBy("doc_id").agg((F.min("quality").cast("int") == 1).alias("good"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                rows = pa.array(features(batch.column("text")).tolist(), pa.list_(pa.float64()))
                yield pa.record_batch([batch.column("doc_id"), rows], names=["doc_id", "x"])

    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x array<double>"
    chosen = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~_held_out())
    return fit(stage(chosen.mapInArrow(run, kinds).join(known, "doc_id").select("doc_id", "good", "x"), "features"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from CUT on).

    Null texts are scored as empty ones. Columns of these names are replaced.
    """
    configure(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = model.scores(features(batch.column("text")))
                arrays = [*batch.columns, pa.array(score), pa.array((score >= CUT).astype(np.int32))]
                yield pa.record_batch(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    found = scored(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", _held_out().alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, all columns."""
    found = scored(docs.withColumn("_kept", F.struct("*")).select("text", "_kept"), train(docs, labels))
    return found.filter("predicted = 1").select("_kept.*")
