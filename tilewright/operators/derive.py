"""Granule attributes to catalog items, with bad rows marked instead of lost."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import names, times
from tilewright.functions.cells import home_cell
from tilewright.functions.footprint import footprint, pixel_size
from tilewright.functions.projection import is_supported
from tilewright.schemas import ITEM_JSON, PROPERTY_TYPES

# Version of the granules, extension schemas of an item.
VERSION = "002"
EXTENSIONS = (
    "https://stac-extensions.github.io/projection/v2.0.0/schema.json",
    "https://stac-extensions.github.io/alternate-assets/v1.2.0/schema.json",
    "https://stac-extensions.github.io/version/v1.2.0/schema.json",
    "https://stac-extensions.github.io/sat/v1.1.0/schema.json",
)
# Attributes without which a granule is no item.
NEEDED = ("id_img1", "date_dt", "roi_valid_percentage")
DEFAULT_COLLECTION = "granules"


def _sensor_known(token: Column) -> Column:
    return F.coalesce(token.isin(*names.SENSORS), F.lit(False))


def granule_error() -> Column:
    """Why a granule cannot become an item, null when it can. The first reason wins."""
    axes = [F.col(c).cast("double") for c in ("x_first", "x_last", "y_first", "y_last")]
    sizes = [pixel_size(F.col("geotransform"), axis) for axis in ("x", "y")]
    placed = reduce(and_, [x.isNotNull() & ~F.isnan(x) for x in [*axes, *sizes]])
    complete = reduce(and_, [F.col(c).isNotNull() for c in NEEDED])
    dated = F.col("_start").isNotNull() & F.col("_end").isNotNull() & F.col("_mid").isNotNull()
    first, second = (names.sensor_token(F.col("url"), i) for i in (1, 2))
    return (
        F.when(~placed, F.lit("no geometry"))
        .when(~is_supported(F.col("spatial_epsg")), F.lit("unsupported projection"))
        .when(~dated, F.lit("bad date"))
        .when(~complete, F.lit("missing attribute"))
        .when(~_sensor_known(names.first_token(F.col("id_img1"))), F.lit("unexpected platform"))
        .when(~_sensor_known(first), F.lit("unexpected sensor of image 1"))
        .when(~_sensor_known(second), F.lit("unexpected sensor of image 2"))
        .when(F.col("_place").isNull(), F.lit("no footprint"))
    )


def mission(platform: Column) -> Column:
    """Mission directory of a platform token."""
    return (
        F.when(platform.startswith("S1"), F.lit("sentinel1"))
        .when(platform.startswith("S2"), F.lit("sentinel2"))
        .when(platform.isNotNull(), F.lit("landsatOLI"))
    )


def derive_items(
    granules: DataFrame,
    collection: str = DEFAULT_COLLECTION,
    version: str = VERSION,
) -> DataFrame:
    """Every granule as a catalog row with an ``error`` column; other columns are kept.

    A narrow transformation: no shuffle, one pass. Write the result before searching it.
    """
    dated = granules.withColumns(
        {
            "_start": times.parse_instant(F.col("acquisition_date_img1")),
            "_end": times.parse_instant(F.col("acquisition_date_img2")),
            "_mid": times.parse_instant(F.col("date_center")),
            "_created": times.parse_instant(F.col("date_created")),
            "_updated": times.updated_or_created(F.col("date_updated"), F.col("date_created")),
        }
    )
    placed = dated.withColumn("_place", footprint()).withColumn("error", granule_error())
    url, platform = F.col("url"), names.first_token(F.col("id_img1"))
    inputs = {
        "acquisition_date_img1", "acquisition_date_img2", "date_center", "roi_valid_percentage",
        "flight_direction_img1", "path_img1", "row_img1", "path_img2", "row_img2", "date_created",
        "date_updated", "id_img1", "id_img2", "date_dt", "spatial_epsg",
    }
    kept = [F.col(c) for c in granules.columns if c not in inputs]
    return placed.select(
        *kept,
        names.item_id(url).alias("id"),
        F.lit(collection).alias("collection"),
        F.col("_place.ring").alias("ring"),
        F.col("_place.bbox").alias("bbox"),
        F.col("_mid").alias("datetime"),
        times.iso_utc(F.col("_mid")).alias("mid_datetime"),
        times.iso_utc(F.col("_created")).alias("created"),
        times.iso_utc(F.col("_updated")).alias("updated"),
        F.col("_place.center.lat").alias("latitude"),
        F.col("_place.center.lon").alias("longitude"),
        F.rint("date_dt").alias("date_dt"),
        platform.alias("platform"),
        F.col("id_img1").alias("scene_1_id"),
        F.col("id_img2").alias("scene_2_id"),
        names.path_row(F.col("path_img1"), F.col("row_img1")).alias("scene_1_path_row"),
        names.path_row(F.col("path_img2"), F.col("row_img2")).alias("scene_2_path_row"),
        F.coalesce(F.col("flight_direction_img1"), F.lit("N/A")).alias("sat:orbit_state"),
        times.iso_utc(F.col("_start")).alias("start_datetime"),
        times.iso_utc(F.col("_end")).alias("end_datetime"),
        F.rint("roi_valid_percentage").cast("int").alias("percent_valid_pixels"),
        F.concat(F.lit("EPSG:"), F.col("spatial_epsg").cast("string")).alias("proj:code"),
        F.lit(version).alias("version"),
        names.asset_map(url).alias("assets"),
        mission(platform).alias("mission"),
        home_cell(F.col("_place.center.lon"), F.col("_place.center.lat")).alias("cell"),
        F.year("_mid").alias("year"),
        F.col("_start").alias("start_ts"),
        F.col("_end").alias("end_ts"),
        F.col("error"),
    )


def good_items(derived: DataFrame) -> DataFrame:
    return derived.filter(F.col("error").isNull())


def quarantine(derived: DataFrame) -> DataFrame:
    """Failed granules as ``(url, error)``; the rest of the job is not held up by them."""
    return derived.filter(F.col("error").isNotNull()).select("url", "error")


def errors_by_reason(derived: DataFrame) -> DataFrame:
    return quarantine(derived).groupBy("error").agg(F.count("*").alias("n"))


def stac_record(items: DataFrame) -> Column:
    """The nested item record, ready for ``to_json``; fits ``schemas.ITEM_JSON``."""
    box = F.col("bbox")
    ring = F.transform("ring", lambda p: F.array(p["lon"], p["lat"]))
    assets = F.transform_values(
        "assets",
        lambda _, a: F.struct(
            a["href"].alias("href"),
            a["type"].alias("type"),
            a["roles"].alias("roles"),
            F.when(
                a["alternate"].isNotNull(),
                F.transform_values(
                    a["alternate"],
                    lambda _, o: F.struct(
                        o["href"].alias("href"), o["name"].alias("alternate:name")
                    ),
                ),
            ).alias("alternate"),
        ),
    )
    return F.struct(
        F.lit("Feature").alias("type"),
        F.lit("1.1.0").alias("stac_version"),
        F.array(*[F.lit(e) for e in EXTENSIONS]).alias("stac_extensions"),
        F.col("id"),
        F.col("collection"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias(
            "geometry"
        ),
        F.array(box["xmin"], box["ymin"], box["xmax"], box["ymax"]).alias("bbox"),
        F.struct(
            F.col("mid_datetime").alias("datetime"), *[F.col(f"`{p}`") for p in PROPERTY_TYPES]
        ).alias("properties"),
        F.array().cast("array<string>").alias("links"),
        assets.alias("assets"),
    )


def item_lines(items: DataFrame, *keep: str) -> DataFrame:
    """One JSON line per item in ``line``, beside the columns to keep."""
    return items.select(*keep, F.to_json(stac_record(items)).alias("line"))


def from_lines(lines: DataFrame) -> DataFrame:
    """Catalog rows out of parsed item records (the inverse of :func:`stac_record`).

    Columns beside the record, such as partition values, are kept.
    """
    kept = [F.col(f"`{c}`") for c in lines.columns if c not in ITEM_JSON.names]

    point = lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))
    box = F.col("bbox")
    alternate = lambda _, o: F.struct(
        o["href"].alias("href"), o["alternate:name"].alias("name")
    )
    asset = lambda _, a: F.struct(
        a["href"].alias("href"),
        a["type"].alias("type"),
        a["roles"].alias("roles"),
        F.when(
            a["alternate"].isNotNull(), F.transform_values(a["alternate"], alternate)
        ).alias("alternate"),
    )
    return lines.select(
        "id",
        "collection",
        F.transform(F.col("geometry.coordinates")[0], point).alias("ring"),
        F.struct(*[box[i].alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))]).alias(
            "bbox"
        ),
        F.try_to_timestamp(F.col("properties.datetime")).alias("datetime"),
        *[F.col(f"properties.`{p}`").alias(p) for p in PROPERTY_TYPES],
        F.transform_values("assets", asset).alias("assets"),
        *kept,
    )
