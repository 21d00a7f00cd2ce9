"""Checks of items against rules, their own consistency and the collection's declaration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Queryable properties with their lowest and highest value.
QUERYABLES = {"percent_valid_pixels": (0, 100), "date_dt": (7, 180)}
# What the collection declares.
DECLARED_INTERVAL = ("1984-01-01T00:00:00Z", "2023-12-31T23:59:59Z")
DECLARED_BOX = (-180.0, -90.0, 180.0, 90.0)
DECLARED_CODES = ("EPSG:3413", "EPSG:4326", "EPSG:3031")
REQUIRED = ("id", "collection", "ring", "bbox", "datetime", "assets")


def _findings(df: DataFrame, rules: dict[str, Column], keep=("id",)) -> DataFrame:
    """One row ``(*keep, rule)`` per broken rule."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return df.select(*keep, F.explode(broken).alias("rule"))


def range_violations(items: DataFrame, queryables: dict = QUERYABLES) -> DataFrame:
    rules = {}
    for name, (low, high) in queryables.items():
        rules[f"{name} below {low}"] = F.col(f"`{name}`") < low
        rules[f"{name} above {high}"] = F.col(f"`{name}`") > high
    return _findings(items, rules)


def violations_per_rule(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rule").agg(F.count("*").alias("n"))


def item_faults(items: DataFrame) -> DataFrame:
    """Rows ``(id, rule)`` of items that are no valid records."""
    box, ring = F.col("bbox"), F.col("ring")
    rules: dict[str, Column] = {f"{c} missing": F.col(c).isNull() for c in REQUIRED}
    rules |= {
        "box out of order": (box["xmin"] > box["xmax"]) | (box["ymin"] > box["ymax"]),
        "ring not closed": (F.size(ring) < 4)
        | (F.try_element_at(ring, F.lit(1)) != F.try_element_at(ring, F.lit(-1))),
        "dates out of order": F.col("start_datetime") > F.col("end_datetime"),
        "no data asset": ~F.coalesce(F.col("assets")["data"]["href"].endswith(".nc"), F.lit(False)),
    }
    return _findings(items, rules)


def undeclared(
    items: DataFrame, interval=DECLARED_INTERVAL, box=DECLARED_BOX, codes=DECLARED_CODES
) -> DataFrame:
    """Rows ``(id, rule)`` of items outside what their collection declares."""
    start, end = (F.lit(t).cast("timestamp") for t in interval)
    b = F.col("bbox")
    rules = {
        "outside interval": (F.col("datetime") < start) | (F.col("datetime") > end),
        "outside box": (b["xmin"] < box[0])
        | (b["ymin"] < box[1])
        | (b["xmax"] > box[2])
        | (b["ymax"] > box[3]),
        "projection not declared": ~F.col("`proj:code`").isin(*codes),
    }
    return _findings(items, rules)
