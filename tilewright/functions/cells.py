"""The 10 degree grid that the catalog is filed under, and hexagonal cell ids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.geometry import (
    area,
    box_geometry,
    box_ring,
    geometries_meet,
    geometry_box,
    intersects,
)

# Mission directories of the catalog.
MISSIONS = ("landsatOLI", "sentinel1", "sentinel2")
CELL_DEGREES = 10


def cell_name(lat_center: Column, lon_center: Column) -> Column:
    """``N60W050``: the cell is named after its centre; 0 is north and east."""
    lat, lon = lat_center.cast("int"), lon_center.cast("int")
    return F.concat(
        F.when(lat >= 0, "N").otherwise("S"),
        F.lpad(F.abs(lat).cast("string"), 2, "0"),
        F.when(lon >= 0, "E").otherwise("W"),
        F.lpad(F.abs(lon).cast("string"), 3, "0"),
    )


def one_meridian(lon_center: Column) -> Column:
    """The cell around 180 degrees has one name, that of -180."""
    return F.when(lon_center == 180, F.lit(-180)).otherwise(lon_center)


def home_center(degrees: Column) -> Column:
    """Centre of the cell holding a coordinate; the lower edge belongs to the cell."""
    return (F.floor((degrees + 5) / 10) * 10).cast("int")


def home_cell(lon: Column, lat: Column, raw: bool = False) -> Column:
    """Cell a point is filed under. ``raw`` keeps both names of the cell around 180."""
    center = home_center(lon)
    return cell_name(home_center(lat), center if raw else one_meridian(center))


def place_key(bbox: Column, bits: int = 16) -> Column:
    """A number that keeps neighbours together: the place of a box's centre on a Hilbert curve.

    Rows sorted by it fall into blocks that are narrow in longitude and in latitude, so that the
    statistics of row groups rule out most of a partition for a small box.
    """
    size = 1 << bits
    lon = F.pmod((bbox["xmin"] + bbox["xmax"]) / 2 + 180, F.lit(360.0)) / 360.0
    lat = ((bbox["ymin"] + bbox["ymax"]) / 2 + 90) / 180.0
    x, y = (F.least(F.floor(v * float(size)), F.lit(size - 1)).cast("bigint") for v in (lon, lat))

    def step(at: Column, side: Column) -> Column:
        """The quarter at one scale, and the centre as seen from within it, turned as the curve is."""
        right, upper = (at[axis].bitwiseAND(side) > 0 for axis in ("x", "y"))
        quarter = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0))
        across = ~upper & right
        flip = {axis: F.when(across, size - 1 - at[axis]).otherwise(at[axis]) for axis in ("x", "y")}
        return F.struct(
            F.when(upper, flip["x"]).otherwise(flip["y"]).alias("x"),
            F.when(upper, flip["y"]).otherwise(flip["x"]).alias("y"),
            (at["key"] + side * side * quarter).alias("key"),
        )

    begin = F.struct(x.alias("x"), y.alias("y"), F.lit(0).cast("bigint").alias("key"))
    sides = F.array(*[F.lit(1 << i).cast("bigint") for i in reversed(range(bits))])
    return F.aggregate(sides, begin, step, lambda at: at["key"])


def _touched(low: Column, high: Column, limit: int) -> Column:
    first = F.greatest(F.ceil((low - 5) / 10) * 10, F.lit(-limit))
    last = F.least(F.floor((high + 5) / 10) * 10, F.lit(limit))
    steps = F.sequence(first.cast("int"), last.cast("int"), F.lit(10))
    return F.when(first <= last, steps)


def touched_cells(df: DataFrame, bbox: str = "bbox") -> DataFrame:
    """One row per grid cell whose closed square touches the row's box: adds ``lat_c, lon_c``."""
    box = F.col(bbox)
    return df.withColumn("lat_c", F.explode(_touched(box["ymin"], box["ymax"], 90))).withColumn(
        "lon_c", F.explode(_touched(box["xmin"], box["xmax"], 180))
    )


def cell_cover(rois: DataFrame, raw: bool = False) -> DataFrame:
    """Rows ``(roi_id, cell)``: the cells that each query geometry intersects.

    ``rois`` has ``roi_id, chains, bbox``. The cells come from the box by arithmetic, so no
    cell table is joined; only those few are tested against the polygon.
    """
    half = F.lit(5.0).cast("double")
    lon, lat = F.col("lon_c").cast("double"), F.col("lat_c").cast("double")
    square = area(box_ring(lon - half, lat - half, lon + half, lat + half))
    name = cell_name(F.col("lat_c"), F.col("lon_c") if raw else one_meridian(F.col("lon_c")))
    return (
        touched_cells(rois)
        .filter(intersects(F.col("chains"), square))
        .select("roi_id", name.alias("cell"))
        .distinct()
    )


def with_missions(cover: DataFrame) -> DataFrame:
    """Every covered cell under every mission directory."""
    return cover.withColumn("mission", F.explode(F.array(*[F.lit(m) for m in MISSIONS])))


def cover_names(geometry: dict) -> list[str]:
    """Cells one query geometry intersects, on the driver: at most a few hundred squares."""
    x0, y0, x1, y1 = geometry_box(geometry)
    names = set()
    for lat in range(math.ceil((y0 - 5) / 10) * 10, math.floor((y1 + 5) / 10) * 10 + 1, 10):
        for lon in range(math.ceil((x0 - 5) / 10) * 10, math.floor((x1 + 5) / 10) * 10 + 1, 10):
            square = box_geometry((lon - 5, lat - 5, lon + 5, lat + 5))
            if abs(lon) <= 180 and geometries_meet(geometry, square):
                center = -180 if lon == 180 else lon
                names.add(
                    f"{'N' if lat >= 0 else 'S'}{abs(lat):02d}"
                    f"{'E' if center >= 0 else 'W'}{abs(center):03d}"
                )
    return sorted(names)


def hex_directory(cell: Column) -> Column:
    """Integer directory name of a hexadecimal cell id."""
    return F.conv(cell, 16, 10).cast("bigint")
