"""Joins whose keys may be very unevenly filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table of hot keys is sent to every executor only up to this many rows.
HOT_KEYS_LIMIT = 100_000


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: Column,
    rows_per_task: int = 1_000_000,
    how: str = "inner",
) -> DataFrame:
    """Equi-join where hot keys of ``left`` are spread over several tasks.

    One counting pass finds the keys with more than ``rows_per_task`` rows; there are at most
    rows / rows_per_task of them. Their rows get a salt from ``spread``, and the matching
    rows of ``right`` are repeated once per salt. Without hot keys it is a plain join, whose
    strategy is left to the planner.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep the left side can be salted on it")
    hot = (
        left.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )
    rows = hot.limit(HOT_KEYS_LIMIT + 1).collect()
    if not rows:
        return left.join(right, keys, how)
    if len(rows) <= HOT_KEYS_LIMIT:
        hot = F.broadcast(left.sparkSession.createDataFrame(rows, hot.schema))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted = (
        left.join(hot, keys, "left")
        .withColumn("_salt", F.pmod(spread, salts).cast("int"))
        .drop("_salts")
    )
    repeated = (
        right.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
