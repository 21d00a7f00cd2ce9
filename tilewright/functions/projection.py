"""Projected coordinates to longitude and latitude.

Closed forms (Snyder, USGS Professional Paper 1395; Karney, *Transverse Mercator with an
accuracy of a few nanometers*, 2011) for the coordinate systems that the data use:
polar stereographic EPSG:3413 and EPSG:3031, and WGS 84 / UTM EPSG:326zz and EPSG:327zz.

They run as Arrow UDFs over numpy batches: for 600,000 footprints the same formulas as
built-in column functions took 7 to 8 s on eight threads, the Arrow batches 0.8 s, with
equal results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tilewright.schemas import POINT

# WGS 84, and the parameters of the coordinate systems.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
POLAR = {3413: (70.0, -45.0, 1.0), 3031: (71.0, 0.0, -1.0)}  # true-scale latitude, meridian, pole
UTM_SCALE, UTM_EASTING, UTM_NORTHING_SOUTH = 0.9996, 500000.0, 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Series from conformal to geodetic latitude, and of the inverse Mercator, to n**4.
LATITUDE_SERIES = (
    2 * _N - 2 / 3 * _N**2 - 2 * _N**3 + 116 / 45 * _N**4,
    7 / 3 * _N**2 - 8 / 5 * _N**3 - 227 / 45 * _N**4,
    56 / 15 * _N**3 - 136 / 35 * _N**4,
    4279 / 630 * _N**4,
)
MERCATOR_SERIES = (
    _N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3 - 1 / 360 * _N**4,
    1 / 48 * _N**2 + 1 / 15 * _N**3 - 437 / 1440 * _N**4,
    17 / 480 * _N**3 - 37 / 840 * _N**4,
    4397 / 161280 * _N**4,
)


def polar_factor(true_scale: float) -> float:
    """Radius on the map over the conformal radius, inverted."""
    phi = math.radians(true_scale)
    s = _E * math.sin(phi)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (_E / 2)
    return t * math.sqrt(1 - s * s) / (SEMI_MAJOR * math.cos(phi))


def is_supported(epsg: Column) -> Column:
    """Whether coordinates of this code can be converted."""
    code = epsg.cast("int")
    utm = code.between(32601, 32660) | code.between(32701, 32760)
    return F.coalesce(code.isin(*POLAR) | utm, F.lit(False))


def _geodetic(chi):
    return chi + sum(c * np.sin(2 * (j + 1) * chi) for j, c in enumerate(LATITUDE_SERIES))


def _wrapped(lon):
    """Longitudes in -180 to 180."""
    return np.where(lon < -180, lon + 360, np.where(lon > 180, lon - 360, lon))


def _from_polar(x, y, true_scale, meridian, pole):
    chi = np.pi / 2 - 2 * np.arctan(np.sqrt(x * x + y * y) * polar_factor(true_scale))
    lon = meridian + np.degrees(np.arctan2(x, -pole * y))
    return _wrapped(lon), pole * np.degrees(_geodetic(chi))


def _from_utm(x, y, meridian, south):
    xi = (y - np.where(south, UTM_NORTHING_SOUTH, 0.0)) / (UTM_SCALE * RECTIFYING)
    eta = (x - UTM_EASTING) / (UTM_SCALE * RECTIFYING)
    xi1, eta1 = xi, eta
    for j, c in enumerate(MERCATOR_SERIES):
        m = 2 * (j + 1)
        xi1 = xi1 - c * np.sin(m * xi) * np.cosh(m * eta)
        eta1 = eta1 - c * np.cos(m * xi) * np.sinh(m * eta)
    chi = np.arcsin(np.sin(xi1) / np.cosh(eta1))
    lon = meridian + np.degrees(np.arctan2(np.sinh(eta1), np.cos(xi1)))
    return _wrapped(lon), np.degrees(_geodetic(chi))


def lonlat_arrays(epsg, x, y):
    """Longitudes and latitudes of ``(rows, points)`` arrays; NaN where unsupported."""
    lon, lat = np.full(x.shape, np.nan), np.full(x.shape, np.nan)
    for code, params in POLAR.items():
        rows = epsg == code
        if rows.any():
            lon[rows], lat[rows] = _from_polar(x[rows], y[rows], *params)
    zone = epsg % 100
    rows = np.isin(epsg // 100, (326, 327)) & (zone >= 1) & (zone <= 60)
    if rows.any():
        meridian = (6.0 * zone[rows] - 183.0)[:, None]
        south = (epsg[rows] // 100 == 327)[:, None]
        lon[rows], lat[rows] = _from_utm(x[rows], y[rows], meridian, south)
    return lon, lat


def numbers(column: pa.Array) -> np.ndarray:
    """Doubles of an Arrow column, NaN for null."""
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def codes(column: pa.Array) -> np.ndarray:
    """Integers of an Arrow column, 0 for null."""
    return column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)


@F.arrow_udf(POINT)
def _point_lonlat(epsg: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    lon, lat = lonlat_arrays(codes(epsg), numbers(x)[:, None], numbers(y)[:, None])
    lon, lat = lon[:, 0], lat[:, 0]
    fields = [pa.array(lon, from_pandas=True), pa.array(lat, from_pandas=True)]
    return pa.StructArray.from_arrays(fields, ["lon", "lat"], mask=pa.array(np.isnan(lon)))


def lonlat(epsg: Column, x: Column, y: Column) -> Column:
    """``struct<lon,lat>`` of a projected point; null when the code is unsupported."""
    return _point_lonlat(epsg.cast("int"), x.cast("double"), y.cast("double"))
