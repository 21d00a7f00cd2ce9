"""Catalog search: prune partitions, push box, time and property tests down, test polygons last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.cells import MISSIONS, cover_names
from tilewright.functions.footprint import search_bbox
from tilewright.functions.geometry import (
    both_sides,
    box_geometry,
    boxes_on_map,
    intersects_geometry,
    item_area,
    overlaps_any,
)
from tilewright.functions.times import split_interval
from tilewright.operators.filters import conjunction, data_hrefs, in_interval
from tilewright.sources.catalog import child_directories, read_catalog, read_extents

PRUNE = ("exact", "home", "none")


def candidate_cells(
    spark: SparkSession,
    path: str,
    geometry: dict,
    prune: str,
    missions=MISSIONS,
    datetime: str | None = None,
) -> list[tuple[str, str]] | None:
    """``(mission, cell)`` directories a search has to open; None means all of them.

    ``exact`` keeps the partitions whose recorded extent touches the geometry's box, so an
    item filed next door is still found. ``home`` keeps the cells that the geometry
    touches, as directory-based searches do. Partitions outside the time interval are left out
    of either. Both lists are bounded by the grid.
    """
    if prune == "none":
        return None
    extents = read_extents(spark, path)
    if prune == "exact":
        if extents is None:
            return None
        touched = extents.filter(overlaps_any(F.col("bbox"), boxes_on_map(geometry)))
    else:
        names = cover_names(both_sides(geometry))
        if extents is None:  # one listing per mission
            have = {
                (m, c.removeprefix("cell="))
                for m in missions
                for c in child_directories(spark, f"{path}/mission={m}")
            }
            return sorted(p for p in have if p[1] in names)
        touched = extents.filter(F.col("cell").isin(names))
    start, end = split_interval(datetime)
    if start is not None:
        touched = touched.filter(F.col("last") >= F.lit(start).cast("timestamp"))
    if end is not None:
        touched = touched.filter(F.col("first") <= F.lit(end).cast("timestamp"))
    rows = touched.filter(F.col("mission").isin(*missions)).select("mission", "cell").distinct()
    return sorted((r["mission"], r["cell"]) for r in rows.collect())


def search(
    spark: SparkSession,
    path: str,
    intersects: dict | None = None,
    bbox=None,
    datetime: str | None = None,
    filters=None,
    collection: str | None = None,
    missions=MISSIONS,
    prune: str = "exact",
    max_items: int | None = None,
) -> DataFrame:
    """Catalog rows that match. Give a GeoJSON geometry or a box, or neither for no spatial test.

    A geometry may reach over 180 degrees, with longitudes beyond it, and so may items.
    ``datetime`` is an instant or an interval open at either end with ``..`` or nothing.
    ``filters`` is a list of comparisons, or a tree of them under and, or, not.
    """
    if prune not in PRUNE:
        raise ValueError(f"prune is one of {PRUNE}")
    geometry = intersects if bbox is None else box_geometry(bbox)
    only = None if geometry is None else candidate_cells(
        spark, path, geometry, prune, missions, datetime
    )
    rows = read_catalog(spark, path, only=only)
    if tuple(missions) != MISSIONS:
        rows = rows.filter(F.col("mission").isin(*missions))
    rows = matching(rows, geometry, datetime, filters, collection, year="year")
    return rows if max_items is None else rows.orderBy("id").limit(max_items)


def matching(
    rows: DataFrame,
    geometry: dict | None = None,
    datetime: str | None = None,
    filters=None,
    collection: str | None = None,
    year: str | None = None,
) -> DataFrame:
    """The predicates of a search on any frame of items: cheap and pushable ones first."""
    test = in_interval(datetime, year=year) & conjunction(filters)
    if collection is not None:
        test &= F.col("collection") == collection
    if geometry is not None:
        test &= overlaps_any(F.col("bbox"), boxes_on_map(geometry))
    rows = rows.filter(test)
    if geometry is not None:
        rows = rows.filter(intersects_geometry(item_area(F.col("ring")), both_sides(geometry)))
    return rows


def search_hrefs(
    spark: SparkSession, path: str, suffix: str = ".nc", role: str = "data", **query
) -> DataFrame:
    """Sorted distinct data links of the matching items."""
    return data_hrefs(search(spark, path, **query), suffix, role).distinct().orderBy("href")


def matches_by_partition(rows: DataFrame) -> DataFrame:
    """Matching items per partition prefix."""
    return rows.groupBy("mission", "cell").agg(F.count("*").alias("n"))


def search_granule(granules: DataFrame) -> DataFrame:
    """Search boxes ``(url, bbox)`` of granules, to search for what overlaps them."""
    return granules.select("url", search_bbox().alias("bbox"))
