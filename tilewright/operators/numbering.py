"""Row, batch, page and chunk numbers in a total order, without one task sorting a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tilewright.staging import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def number_rows(
    df: DataFrame, group: list[str], order: list[str], name: str = "row_no"
) -> DataFrame:
    """Numbers rows 1, 2, ... per group in the order given, however large a group is.

    Rows are range-partitioned and sorted by group and order, so each partition holds a
    contiguous run; the run is written with its position. Per partition and group, the first
    position and the count give an offset, and position - first + offset is the row
    number. Only the offsets, one row per partition and group, go through a window; they are
    written too, so the planner knows their size and broadcasts them only when small. The
    order has to be total; rows with equal keys are numbered arbitrarily. Range partitioning
    samples its input first, so give it a table rather than a long computation.
    """
    ordered = df.repartitionByRange(*[F.col(c) for c in [*group, *order]]).sortWithinPartitions(
        *group, *order
    )
    runs = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _ROW_BITS)
    counts = (
        runs.groupBy(*group, part.alias("_part"))
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    )
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        "_part",
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    offsets = stage(offsets, "offsets")
    numbered = runs.withColumn("_part", part)
    same = numbered["_part"] == offsets["_part"]
    for c in group:
        same &= numbered[c].eqNullSafe(offsets[f"_g_{c}"])
    number = F.col("_at") - F.col("_first") + F.col("_offset") + 1
    return numbered.join(offsets, same).select(
        *[F.col(f"`{c}`") for c in df.columns], number.cast("bigint").alias(name)
    )


def batches(
    df: DataFrame, group: list[str], order: list[str], size: int, name: str = "batch"
) -> DataFrame:
    """Fixed-size batches or pages in order, numbered from 0 per group."""
    numbered = number_rows(df, group, order, "_row_no")
    number = F.floor((F.col("_row_no") - 1) / size).cast("bigint")
    return numbered.withColumn(name, number).drop("_row_no")


def listing_batches(listing: DataFrame, size: int) -> DataFrame:
    """Batches of a listing ``(region, key)`` in the byte order of the keys."""
    return batches(listing, ["region"], ["key"], size)


def _last_batches(state: DataFrame) -> DataFrame:
    """``region, _last``, written first: by its known size the planner sends a small state to the
    rows' tasks, where a shuffle would bring all rows of a region to one."""
    return stage(state.select("region", F.col("last_batch").alias("_last")), "state")


def pending(batched: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of batches past the last one finished, per region; -1 when there is no state."""
    joined = batched.join(_last_batches(state), "region", "left")
    return joined.filter(F.col("batch") > F.coalesce(F.col("_last"), F.lit(-1))).drop("_last")


def remaining_batches(
    listing: DataFrame, processed: DataFrame, state: DataFrame, size: int
) -> DataFrame:
    """Batches of the keys of a listing that are not among the processed ``(region, key)``.

    They are numbered behind the region's last batch, so a key that was listed late gets a new
    batch, wherever it sorts, and a batch that was not full is left as it is.
    """
    todo = stage(listing.join(processed, ["region", "key"], "left_anti"), "remaining")
    numbered = listing_batches(todo, size).join(_last_batches(state), "region", "left")
    behind = F.col("batch") + F.coalesce(F.col("_last"), F.lit(-1)) + 1
    return numbered.withColumn("batch", behind).drop("_last")


def number_chunks(items: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """Adds ``chunk``: the number of the chunk file that an item of ``(region, year, batch)`` goes to.

    A year's counter moves on only with batches in which the year occurs, so chunk numbers
    are ranks of batches within region and year, from the counter of earlier runs on. Ranks
    are taken over the distinct batches, never over the items.
    """
    keys = stage(items.select("region", "year", "batch").distinct(), "batch-keys")
    ranks = number_rows(keys, ["region", "year"], ["batch"], "_rank")
    base: Column = F.lit(0)
    if counters is not None:
        known = counters.select("region", "year", F.col("counter").alias("_base"))
        ranks = ranks.join(known, ["region", "year"], "left")
        base = F.coalesce(F.col("_base"), F.lit(0))
    ranks = ranks.select(
        "region", "year", "batch", (base + F.col("_rank") - 1).cast("int").alias("chunk")
    )
    return items.join(ranks, ["region", "year", "batch"])
