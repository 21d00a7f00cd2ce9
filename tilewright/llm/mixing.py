"""Mixing sources to target weights.

Sources, in code point order with null last, weigh WEIGHTS in turn and share ``share`` times all
words; a source's target stops at ``most`` times its own words, and what is cut off is shared
again by weight until no target is above. That settles at ``least(most * words, level * weight)``
with one level for all sources: sources are capped in ascending order of words per weight, and
the level is what the others share by weight.

A source's rate is its target over its words. Each of its documents is taken ``floor(rate)`` times,
and once more when a number in [0, 1) drawn by hash from its id and text is below the rest of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.staging import stage

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def draw(doc_id: str, text: str, seed: str) -> Column:
    """A number in [0, 1) from the first 32 bits of a hash of seed, id and text."""
    named = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    drawn = F.concat_ws("/", F.lit(seed), named, F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(drawn), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target``, one row per source.

    The windows run over one row per source, not over documents.
    """
    turn = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (turn - 1) % len(WEIGHTS) + 1)
    weighed = sizes.withColumn("weight", weight)
    order = W.partitionBy(F.lit(0)).orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(0))
    capped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(most))
    # the level if this source and all later ones were below their caps
    level = (F.sum("source_size").over(whole) * F.lit(share) - capped) / F.sum("weight").over(after)
    cap = F.col("source_size") * F.lit(float(most))
    trial = weighed.withColumn("level", level)
    # the first source below its cap settles the level
    key = F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    below = F.when(F.col("level") * F.col("weight") <= cap, key)
    settled = F.coalesce(F.min_by("level", below).over(whole), F.lit(0.0))
    target = F.least(cap, settled * F.col("weight"))
    return weighed.withColumn("level", level).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = SHARE, most: int = MOST, seed: str = "mix") -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``: how often the mix takes each document.

    A null text has size 0 and is drawn for like an empty one; a null source is a source of its own,
    after the others; a null ``doc_id`` is drawn for like the text ``null``. Rows sharing a
    ``doc_id`` draw numbers of their own where their texts differ. A source without words has the
    target 0, and its documents are not taken; an empty table gives no rows. Columns of ``docs`` named
    like the new ones are replaced, all others kept.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    drawn = draw("doc_id", "text", seed).alias("drawn")
    sized = docs.select(F.struct(*others).alias("kept"), "source", drawn, word_count().alias("size"))
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source = targets(found, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # one row per source; the planner broadcasts it only when its written size is small
    rates = stage(per_source.withColumn("rate", rate), "rates").withColumnRenamed("source", "_source")
    joined = sized.join(rates, sized["source"].eqNullSafe(rates["_source"]), "left")
    once_more = F.col("drawn") < F.col("rate") - F.floor("rate")
    copies = (F.floor("rate") + once_more.cast("bigint")).cast("bigint")
    return joined.select("kept.*", "size", "source_size", "target", copies.alias("copies"))


def taken(docs: DataFrame, share: float = SHARE, most: int = MOST, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words the mix takes of every document."""
    mixed = mix(docs.select("doc_id", "text", "source"), share, most, seed)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixture(docs: DataFrame, share: float = SHARE, most: int = MOST, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as many times as it is taken, columns as before."""
    kept = docs.select("doc_id", "text", "source", F.struct("*").alias("_kept"))
    mixed = mix(kept, share, most, seed).filter("copies > 0")
    repeated = mixed.select("_kept", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("_kept.*")


ORACLE = r"""
with sized as (
    select doc_id, source, md5(coalesce(text, '')) as content, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
    from documents),
per_source as (
    select source, sum(size)::bigint as source_size,
           (case row_number() over (order by source nulls last) % 3 when 1 then 3 when 2 then 1 else 2 end)::double as weight
    from sized group by source),
capped as (
    select *, 2 * source_size::double as cap,
           1.5::double * (sum(source_size) over ())::bigint as share,
           coalesce(sum(source_size) over (order by source_size / weight, source nulls last
                    rows between unbounded preceding and 1 preceding), 0)::bigint::double * 2 as spent,
           sum(weight) over (order by source_size / weight, source nulls last
                    rows between current row and unbounded following) as others
    from per_source),
settled as (
    select (share - spent) / others as level from capped where (share - spent) / others * weight <= cap
    order by source_size / weight, source nulls last limit 1),
rates as (
    select source, source_size, least(cap, coalesce((select level from settled), 0) * weight) as target,
           case when source_size > 0 then least(cap, coalesce((select level from settled), 0) * weight) / source_size else 0 end as rate
    from capped)
select s.doc_id, s.size, r.source_size, r.target,
       (s.size * (floor(r.rate)::bigint + (
           ('0x' || substr(md5('mix/' || coalesce(s.doc_id::varchar, 'null') || '/' || s.content), 1, 8))::bigint / 4294967296.0::double
           < r.rate - floor(r.rate))::int))::bigint as taken
from sized s join rates r on s.source is not distinct from r.source
"""
