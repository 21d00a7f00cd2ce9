"""Worked-out values and properties of the functions."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright.functions import cells, names, numbers, projection, times
from tilewright.functions import geometry as geo

# Scene pairs of five missions; the names follow the producers' conventions.
PAIRS = {
    "LT05_L1TP_009011_19920706_20200914_02_T1_X_LT05_L1TP_009011_19930506_20200914_02_T1_G0120V02_P011.nc": "1992-12-05",
    "S2A_MSIL1C_20170711T125301_N0205_R138_T27VXL_20170711T125302_X_S2A_MSIL1C_20170830T125301_N0205_R138_T27VXL_20170830T125302_G0120V02_P080.nc": "2017-08-05",
    "LE07_L1TP_009011_20090424_20200912_02_T1_X_LE07_L1TP_009011_20090915_20200911_02_T1_G0120V02_P011.nc": "2009-07-05",
    "LC08_L1TP_219014_20140328_20200911_02_T1_X_LC08_L1TP_219014_20140413_20200911_02_T1_G0120V02_P085.nc": "2014-04-05",
    "LC08_L1TP_011002_20150821_20170405_01_T1_X_LC08_L1TP_011002_20150720_20170406_01_T1_G0240V01_P038.nc": "2015-08-05",
    "S1A_IW_SLC__1SSH_20170221T204710_20170221T204737_015387_0193F6_AB07_X_S1B_IW_SLC__1SSH_20170227T204628_20170227T204655_004491_007D11_6654_G0240V02_P094.nc": "2017-02-24",
}


def box(x0, y0, x1, y1):
    return geo.box_geometry((x0, y0, x1, y1))


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column.alias("v")).first()["v"]


def test_mid_dates(spark):
    df = spark.createDataFrame(list(PAIRS.items()), "name string, day string")
    got = df.select("day", times.mid_date(F.col("name")).cast("string").alias("mid")).collect()
    assert all(r["day"] == r["mid"] for r in got)


def test_two_dates_are_not_enough(spark):
    assert one(spark, times.mid_date(F.col("n")), n="LC08_20150821_X_LC08_20150720.nc") is None


@pytest.mark.parametrize(
    ("box_values", "expected"),
    [
        ((-45.05, 61.92, -43.09, 62.81), ["N60W040", "N60W050"]),
        ((-76.81, 4.325, -69.6, 10.73), ["N00W070", "N00W080", "N10W070", "N10W080"]),
        ((83.22, 31.5, 84.97, 32.83), ["N30E080"]),
        ((-35.12, 71.7, -32.57, 72.27), ["N70W030", "N70W040"]),
        ((178.0, 0.0, 180.0, 1.0), ["N00W180"]),
        ((5.0, 5.0, 6.0, 6.0), ["N00E000", "N00E010", "N10E000", "N10E010"]),
    ],
)
def test_covers(box_values, expected):
    assert cells.cover_names(box(*box_values)) == sorted(expected)


def test_cover_of_a_slanted_polygon():
    ring = [[-64.36, -64.87], [-63.43, -65.66], [-61.56, -65.26], [-62.53, -64.48], [-64.36, -64.87]]
    names_found = cells.cover_names({"type": "Polygon", "coordinates": [ring]})
    assert names_found == ["S60W060", "S70W060"]


def test_catalog_path_is_split(spark):
    url = "s3://store/velocity_image_pair/010W/a/b/c/"
    assert one(spark, names.catalog_base(F.col("u")), u=url) == "s3://store/velocity_image_pair/"
    assert one(spark, names.catalog_relative(F.col("u")), u=url) == "010W/a/b/c/"
    assert one(spark, names.catalog_relative(F.col("u")), u="s3://store/only") == ""


def test_storage_paths_are_decoded(spark):
    path = "s3://my%20store/a%2Bb/c+d/100%/x"
    assert one(spark, names.storage_bucket(F.col("p")), p=path) == "my store"
    assert one(spark, names.storage_prefix(F.col("p")), p="s3://b/a%2Bb/c+d") == "a+b/c+d/"
    assert one(spark, names.storage_prefix(F.col("p")), p="s3://b") == ""


def test_years(spark):
    two = one(spark, times.years_in(F.col("i")), i="1980-01-01T00:00:00Z/1981-12-31T23:59:59Z")
    assert two == ["1980", "1981"]
    assert one(spark, times.years_in(F.col("i")), i="1999-05-01") == ["1999"]


def test_intervals():
    assert times.split_interval("a/b") == ("a", "b")
    assert times.split_interval("a/..") == ("a", None)
    assert times.split_interval("/b") == (None, "b")
    assert times.split_interval("a") == ("a", "a")
    assert times.split_interval(None) == (None, None)


def test_globs(spark):
    regex = names.glob_to_regex("LC0[89]_*P?.nc")
    df = spark.createDataFrame([("LC08_aP1.nc",), ("LC07_aP1.nc",), ("LC09_P12.nc",)], "n string")
    assert [r["n"] for r in df.filter(F.col("n").rlike(regex)).collect()] == ["LC08_aP1.nc"]


def test_exact_rounding_is_that_of_scalars(spark):
    values = [k / 10000 for k in range(-1000050, 1000050, 397)]
    values += [k / 1000 for k in range(-180005, 180005, 10)] + [0.0, -0.004, 2.5, 2.675, 94.705]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", numbers.round_exact(F.col("v"), 2).alias("r")).collect():
        assert r["r"] == round(r["v"], 2), r


def forward_polar(lon, lat, true_scale, meridian, pole):
    """Textbook forward projection, to be undone."""
    e = math.sqrt(projection.FLATTENING * (2 - projection.FLATTENING))

    def t(phi):
        s = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    ts, phi, lam = math.radians(true_scale), math.radians(pole * lat), math.radians(lon - meridian)
    m = math.cos(ts) / math.sqrt(1 - (e * math.sin(ts)) ** 2)
    rho = projection.SEMI_MAJOR * m * t(phi) / t(ts)
    return rho * math.sin(lam), -pole * rho * math.cos(lam)


@settings(max_examples=200, deadline=None)
@given(st.floats(-179.9, 179.9), st.floats(50, 89.9), st.sampled_from([3413, 3031]))
def test_polar_round_trip(lon, lat, code):
    params = projection.POLAR[code]
    lat = lat * params[2]
    x, y = forward_polar(lon, lat, *params)
    back = projection.lonlat_arrays(np.array([code]), np.array([[x]]), np.array([[y]]))
    assert back[0][0, 0] == pytest.approx(lon, abs=1e-8)
    assert back[1][0, 0] == pytest.approx(lat, abs=1e-8)


def forward_utm(lon, lat, zone, south):
    """Forward transverse Mercator by the series of Karney, to be undone."""
    f = projection.FLATTENING
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    phi, lam = math.radians(lat), math.radians(lon - (6 * zone - 183))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi0, eta0 = math.atan2(t, math.cos(lam)), math.asinh(math.sin(lam) / math.hypot(t, math.cos(lam)))
    alpha = (
        n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4,
        13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
        61 / 240 * n**3 - 103 / 140 * n**4,
        49561 / 161280 * n**4,
    )
    xi = xi0 + sum(a * math.sin(2 * j * xi0) * math.cosh(2 * j * eta0) for j, a in enumerate(alpha, 1))
    eta = eta0 + sum(a * math.cos(2 * j * xi0) * math.sinh(2 * j * eta0) for j, a in enumerate(alpha, 1))
    scale = projection.UTM_SCALE * projection.RECTIFYING
    return 500000 + scale * eta, scale * xi + (10000000 if south else 0)


@settings(max_examples=200, deadline=None)
@given(st.floats(-3.5, 3.5), st.floats(0.01, 83.9), st.integers(1, 60), st.booleans())
def test_utm_round_trip(offset, lat, zone, south):
    lon, lat = 6 * zone - 183 + offset, -lat if south else lat
    x, y = forward_utm(lon, lat, zone, south)
    code = np.array([(32700 if south else 32600) + zone])
    back = projection.lonlat_arrays(code, np.array([[x]]), np.array([[y]]))
    assert -180 <= back[0][0, 0] <= 180
    assert (back[0][0, 0] - lon + 180) % 360 == pytest.approx(180, abs=1e-8)
    assert back[1][0, 0] == pytest.approx(lat, abs=1e-8)


def test_utm_longitudes_wrap():
    """Worked-out values at the edges of zones 60 and 1."""
    codes, x, y = np.array([32660, 32601]), np.array([[800000.0], [200000.0]]), np.full((2, 1), 7.2e6)
    lon, _ = projection.lonlat_arrays(codes, x, y)
    assert lon.ravel() == pytest.approx([-176.68, 176.68], abs=0.01)


def test_projection_landmarks():
    codes = np.array([3413, 3031, 3413, 3031, 32633])
    x, y = np.zeros((5, 1)), np.array([[0.0], [0.0], [-2e6], [1e6], [0.0]])
    x[4] = 500000
    lon, lat = projection.lonlat_arrays(codes, x, y)
    assert lat[0, 0] == pytest.approx(90) and lat[1, 0] == pytest.approx(-90)
    assert lon[2, 0] == -45 and lon[3, 0] == 0
    assert (lon[4, 0], lat[4, 0]) == (pytest.approx(15), pytest.approx(0))
    assert np.isnan(projection.lonlat_arrays(np.array([2193]), x[:1], y[:1])[0]).all()


def test_intersects_is_closed():
    unit = box(0, 0, 1, 1)
    assert geo.geometries_meet(unit, box(1, 1, 2, 2))
    assert not geo.geometries_meet(unit, box(1.001, 0, 2, 1))
    assert geo.geometries_meet(unit, box(-1, -1, 2, 2)) and geo.geometries_meet(box(-1, -1, 2, 2), unit)


def test_holes_points_and_lines():
    outer, inner = box(-5, -5, 5, 5)["coordinates"][0], box(-2, -2, 2, 2)["coordinates"][0]
    holed = {"type": "Polygon", "coordinates": [outer, inner]}
    assert not geo.geometries_meet(box(-1, -1, 1, 1), holed)
    assert geo.geometries_meet(box(1, 1, 3, 3), holed)
    assert geo.geometries_meet({"type": "Point", "coordinates": [3, 3]}, holed)
    assert not geo.geometries_meet({"type": "Point", "coordinates": [0, 0]}, holed)
    line = {"type": "LineString", "coordinates": [[-1, 0], [1, 0]]}
    assert not geo.geometries_meet(line, holed)
    both = {"type": "MultiPolygon", "coordinates": [[inner], [box(8, 8, 9, 9)["coordinates"][0]]]}
    assert geo.geometries_meet(line, both) and geo.geometries_meet(box(8.4, 8.4, 8.6, 8.6), both)


coordinate = st.integers(-6, 6)


@settings(max_examples=300, deadline=None)
@given(*[st.tuples(coordinate, coordinate, st.integers(1, 6), st.integers(1, 6)) for _ in range(2)])
def test_boxes_meet_like_their_ranges(a, b):
    first, second = (box(x, y, x + w, y + h) for x, y, w, h in (a, b))
    overlap = (
        a[0] <= b[0] + b[2] and b[0] <= a[0] + a[2] and a[1] <= b[1] + b[3] and b[1] <= a[1] + a[3]
    )
    assert geo.geometries_meet(first, second) == overlap


def test_batches_of_pairs_do_not_change_the_answer(monkeypatch):
    rng = np.random.default_rng(3)
    shapes = [geo.chains_of(box(x, y, x + w, y + w)) for x, y, w in rng.uniform(0, 5, (60, 3))]
    a = geo.chains_array(shapes[0]).take([0] * 60)
    b = geo.pa.concat_arrays([geo.chains_array(s) for s in shapes])
    whole = geo.meets(a, b)
    monkeypatch.setattr(geo, "PAIRS_AT_ONCE", 37)
    assert (geo.meets(a, b) == whole).all() and whole.any() and not whole.all()


def test_geometry_arguments_are_checked():
    with pytest.raises(ValueError):
        geo.box_geometry("1,2,3")
    with pytest.raises(ValueError):
        geo.chains_of({"type": "Blob", "coordinates": []})
    with pytest.raises(ValueError):
        geo.chains_of({"type": "Polygon", "coordinates": []})


def test_one_geometry_against_many_rows_as_against_each():
    rng = np.random.default_rng(8)
    rings = []
    for x, y, w in rng.uniform(-5, 5, (300, 3)):
        w = abs(w) / 4 + 0.01
        rings.append([(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)])
    rows = pa.concat_arrays([geo.chains_array([(True, r)]) for r in rings])
    turn = np.linspace(0, 2 * np.pi, 400)
    radius = 3 + np.sin(9 * turn)
    coast = [*zip((radius * np.cos(turn)).tolist(), (radius * np.sin(turn)).tolist())]
    coast[-1] = coast[0]
    hole = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0)]
    shape = [(True, coast), (True, hole)]
    one = geo.chains_array(shape)
    want = geo.meets(rows, one.take(pa.array([0] * len(rings))))
    got = geo.meets_one(rows, geo._Bands(geo._Edges.of(one)))
    assert (got == want).all() and 0 < got.sum() < len(rings)


def test_a_coastline_needs_little_memory():
    """100,000 vertices against 10,000 boxes, under a gigabyte."""
    import tracemalloc

    turn = np.linspace(0, 2 * np.pi, 100_000)
    coast = [*zip((80 * np.cos(turn)).tolist(), (80 * np.sin(turn)).tolist())]
    coast[-1] = coast[0]
    one = geo._Bands(geo._Edges.of(geo.chains_array([(True, coast)])))
    x, y = np.random.default_rng(1).uniform(-90, 90, (2, 10_000))
    corner = np.array([[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]])
    flat = [pa.array((v[:, None] + corner[:, i]).ravel()) for i, v in ((0, x), (1, y))]
    points = pa.ListArray.from_arrays(np.arange(0, 50_001, 5, dtype=np.int32), pa.StructArray.from_arrays(flat, ["lon", "lat"]))
    chains = pa.StructArray.from_arrays([pa.array([True] * 10_000), points], ["area", "points"])
    rows = pa.ListArray.from_arrays(np.arange(10_001, dtype=np.int32), chains)
    tracemalloc.start()
    hits = geo.meets_one(rows, one)
    assert tracemalloc.get_traced_memory()[1] < 1e9
    tracemalloc.stop()
    middle = np.hypot(x + 0.5, y + 0.5)
    assert hits[middle < 78].all() and not hits[middle > 82].any()


def test_open_rings_are_refused():
    with pytest.raises(ValueError):
        geo.chains_of({"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2]]]})
