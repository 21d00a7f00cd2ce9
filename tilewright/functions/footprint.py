"""Footprint ring, bounding box and centre of a granule from its axis ends."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tilewright.functions.projection import codes, lonlat, lonlat_arrays, numbers
from tilewright.schemas import FOOTPRINT

# The 17 ring points as fractions of width and height from the lower left
# corner, counter-clockwise, four steps per side.
RING_FRACTIONS = (
    (0.0, 0.0), (0.25, 0.0), (0.5, 0.0), (0.75, 0.0),
    (1.0, 0.0), (1.0, 0.25), (1.0, 0.5), (1.0, 0.75),
    (1.0, 1.0), (0.75, 1.0), (0.5, 1.0), (0.25, 1.0),
    (0.0, 1.0), (0.0, 0.75), (0.0, 0.5), (0.0, 0.25),
    (0.0, 0.0),
)


def pixel_size(geotransform: Column, axis: str) -> Column:
    """Signed pixel size out of a six-number transform text; null when malformed."""
    parts = F.split(F.trim(geotransform), r"\s+")
    return F.when(
        F.size(parts) == 6, F.try_element_at(parts, F.lit(2 if axis == "x" else 6))
    ).try_cast("double")


def _points(lon: np.ndarray, lat: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(lon), pa.array(lat)], ["lon", "lat"])


@F.arrow_udf(FOOTPRINT)
def _footprint(
    epsg: pa.Array,
    x_first: pa.Array,
    x_last: pa.Array,
    y_first: pa.Array,
    y_last: pa.Array,
    pixel_x: pa.Array,
    pixel_y: pa.Array,
) -> pa.Array:
    fx, fy = np.array(RING_FRACTIONS).T
    x0, x1, y0, y1 = numbers(x_first), numbers(x_last), numbers(y_first), numbers(y_last)
    half_x, half_y = numbers(pixel_x) / 2, numbers(pixel_y) / 2
    minx, maxx, miny, maxy = x0 - half_x, x1 + half_x, y1 + half_y, y0 - half_y
    x = minx[:, None] + fx * (maxx - minx)[:, None]
    y = miny[:, None] + fy * (maxy - miny)[:, None]
    x = np.column_stack([x, (x0 + x1) / 2])
    y = np.column_stack([y, (y0 + y1) / 2])
    lon, lat = (np.round(a, 4) for a in lonlat_arrays(codes(epsg), x, y))
    bad = np.isnan(lon).any(axis=1) | np.isnan(lat).any(axis=1)
    points = _points(lon[:, :-1].ravel(), lat[:, :-1].ravel())
    offsets = pa.array(np.arange(0, len(points) + 1, len(fx), dtype=np.int32))
    ends = [f(a[:, :-1], axis=1) for f in (np.min, np.max) for a in (lon, lat)]
    bbox = pa.StructArray.from_arrays(
        [pa.array(e) for e in ends], ["xmin", "ymin", "xmax", "ymax"]
    )
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(offsets, points),
            bbox,
            _points(lon[:, -1], lat[:, -1]),
        ],
        ["ring", "bbox", "center"],
        mask=pa.array(bad),
    )


def footprint() -> Column:
    """``struct<ring,bbox,center>`` of the row's granule; null when it cannot be placed."""
    ends = [F.col(n).cast("double") for n in ("x_first", "x_last", "y_first", "y_last")]
    sizes = [pixel_size(F.col("geotransform"), axis) for axis in ("x", "y")]
    return _footprint(F.col("spatial_epsg").cast("int"), *ends, *sizes)


def extent() -> dict[str, Column]:
    """Projected extent from pixel centres: the ends moved out by half a pixel."""
    half_x = pixel_size(F.col("geotransform"), "x") / F.lit(2.0).cast("double")
    half_y = pixel_size(F.col("geotransform"), "y") / F.lit(2.0).cast("double")
    return {
        "minx": F.col("x_first") - half_x,
        "maxx": F.col("x_last") + half_x,
        "miny": F.col("y_last") + half_y,
        "maxy": F.col("y_first") - half_y,
    }


def corners(ring: Column) -> Column:
    """Upper left, upper right, lower right, lower left of a 17-point ring."""
    return F.array(*[F.element_at(ring, i) for i in (13, 9, 5, 1)])


def search_bbox() -> Column:
    """Search box of a granule: lower left and upper right pixel centres converted.

    Only two points are converted, so this differs from the box of the ring.
    """
    epsg = F.col("spatial_epsg")
    low = lonlat(epsg, F.least("x_first", "x_last"), F.least("y_first", "y_last"))
    high = lonlat(epsg, F.greatest("x_first", "x_last"), F.greatest("y_first", "y_last"))
    return F.struct(
        low["lon"].alias("xmin"),
        low["lat"].alias("ymin"),
        high["lon"].alias("xmax"),
        high["lat"].alias("ymax"),
    )
