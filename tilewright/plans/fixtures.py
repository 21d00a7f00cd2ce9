"""Granules, query geometries and listings worked out from the generated tables.

Each view is a list of layers of named SQL expressions, so that Spark and the checking
engine compute the same inputs by the same integer arithmetic. Only the few date functions
that differ are given per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tilewright.operators.derive import derive_items, good_items
from tilewright.schemas import GRANULE
from tilewright.session import configure
from tilewright.sources.catalog import catalog_columns, read_catalog, write_catalog
from tilewright.staging import frugal, new_path

# Sites with their coordinate system, first coordinates, spans and zones.
# name: (epsg, zones, x0, x span, y0, y span)
SITES = {
    "greenland": (3413, 1, -600000, 9000, -3300000, 25000),
    "peninsula": (3031, 1, -2400000, 10000, 200000, 14000),
    "hma": (32644, 2, 300000, 3000, 3100000, 9000),
    "alaska": (32601, 6, 300000, 3000, 6500000, 6000),
    "patagonia": (32718, 2, 300000, 3000, 4400000, 8000),
}
STORE = "granule-store"


class _Spark:
    @staticmethod
    def ymd(d):
        return f"date_format({d}, 'yyyyMMdd')"

    @staticmethod
    def dashed(d):
        return f"date_format({d}, 'yyyy-MM-dd')"

    @staticmethod
    def plus(d, n):
        return f"date_add({d}, cast({n} as int))"

    @staticmethod
    def div(a, b):
        return f"(({a}) div {b})"


class _Duck:
    @staticmethod
    def ymd(d):
        return f"strftime({d}, '%Y%m%d')"

    @staticmethod
    def dashed(d):
        return f"strftime({d}, '%Y-%m-%d')"

    @staticmethod
    def plus(d, n):
        return f"cast(({d}) + cast({n} as int) as date)"

    @staticmethod
    def div(a, b):
        return f"(({a}) // {b})"


SPARK, DUCK = _Spark, _Duck


def _pad(e: str, n: int) -> str:
    return f"lpad(cast({e} as string), {n}, '0')"


def _by_site(part: int) -> str:
    cases = " ".join(f"when '{s}' then {v[part]}" for s, v in SITES.items())
    return f"case site {cases} end"


def granule_layers(d) -> list[dict[str, str]]:
    """From ``orders`` to one granule per row, some of them with faults."""
    hms = f"{_pad('k % 24', 2)} || {_pad('k % 60', 2)} || {_pad('c % 60', 2)}"
    clock = f"{_pad('k % 24', 2)} || ':' || {_pad('k % 60', 2)} || ':' || {_pad('c % 60', 2)}"

    def scene(tok: str, date: str) -> str:
        landsat = (
            f"{tok} || '_L1TP_' || {_pad('path', 3)} || {_pad('row', 3)} || '_' || {d.ymd(date)}"
            f" || '_' || {d.ymd(d.plus(date, 300))} || '_02_T1'"
        )
        s1 = (
            f"{tok} || '_IW_SLC__1SSH_' || {d.ymd(date)} || 'T' || {hms} || '_' || {d.ymd(date)}"
            f" || 'T' || {hms} || '_' || {_pad('k % 100000', 6)} || '_0193F6_AB07'"
        )
        s2 = (
            f"{tok} || '_MSIL1C_' || {d.ymd(date)} || 'T' || {hms} || '_N0205_R138_T27VXL_'"
            f" || {d.ymd(date)} || 'T' || {hms}"
        )
        return f"case c % 3 when 0 then {landsat} when 1 then {s1} else {s2} end"

    def token(shift: int) -> str:
        k = f"(k + {shift})"
        return (
            f"case c % 3 when 0 then case {d.div(k, 3)} % 4 when 0 then 'LC08' when 1 then 'LC09'"
            f" when 2 then 'LE07' else 'LT05' end"
            f" when 1 then case {d.div(k, 3)} % 2 when 0 then 'S1A' else 'S1B' end"
            f" else case {d.div(k, 5)} % 2 when 0 then 'S2A' else 'S2B' end end"
        )

    def acquired(date: str) -> str:
        return (
            f"case when k % 613 = 5 then 'n/a'"
            f" when k % 3 = 0 then {d.ymd(date)} || 'T' || {clock}"
            f" when k % 3 = 1 then {d.dashed(date)}"
            f" else {d.dashed(date)} || 'T' || {clock} || '.' || {_pad('c % 1000', 3)} || '000' end"
        )

    return [
        {
            "k": "o_orderkey",
            "c": "o_custkey",
            "d1": "cast(o_orderdate as date)",
            "sep": "cast((1 + (o_orderkey * 13) % 400) * case when o_orderkey % 5 = 0 then -1"
            " else 1 end as int)",
        },
        {
            "site": "case when k % 8 < 3 then 'greenland' when k % 8 < 5 then 'peninsula'"
            " when k % 8 = 5 then 'hma' when k % 8 = 6 then 'alaska' else 'patagonia' end",
            "d2": d.plus("d1", "sep"),
            "tok1": token(0),
            "tok2": f"case when k % 397 = 11 then 'S9Z' else {token(1)} end",
            "path": "cast(case when c % 3 = 0 then 1 + k % 233 end as int)",
            "row": "cast(case when c % 3 = 0 then 1 + c % 248 end as int)",
            "pvp": "cast((c * 31 + k) % 101 as int)",
            "pix": "cast(case when k % 2 = 0 then 240 else 120 end as int)",
            "nx": "100 + k % 200",
            "ny": "120 + c % 150",
        },
        {
            "scene1": scene("tok1", "d1"),
            "id_img2": scene("tok2", "d2"),
            "prefix": "'velocity_image_pair/' || case c % 3 when 0 then 'landsatOLI' when 1 then"
            " 'sentinel1' else 'sentinel2' end || '/v02/' || site",
            "spatial_epsg": f"cast(case when k % 251 = 9 then 2193 else {_by_site(0)} +"
            f" {d.div('k', 8)} % {_by_site(1)} end as int)",
            "x_first": f"cast({_by_site(2)} + (k * 7919 % {_by_site(3)}) * 100 as double)",
            "y_first": f"cast({_by_site(4)} + ((k * 104729 + c) % {_by_site(5)}) * 100 as double)",
        },
        {
            "id_img1": "case when k % 541 = 17 then null when k % 569 = 29 then 'Q' || scene1"
            " else scene1 end",
            "x_last": "case when k % 557 = 23 then cast('NaN' as double) else"
            " x_first + cast((nx - 1) * pix as double) end",
            "y_last": "y_first - cast((ny - 1) * pix as double)",
            "geotransform": "case when k % 499 = 3 then null else"
            f" cast(cast(x_first as bigint) - {d.div('pix', 2)} as string) || ' ' ||"
            " cast(pix as string) || ' 0 ' ||"
            f" cast(cast(y_first as bigint) + {d.div('pix', 2)} as string) || ' 0 -' ||"
            " cast(pix as string) end",
            "path_name": "case when k % 491 = 7 then tok1 || '_' || "
            + d.ymd("d1")
            + " || '_X_' || tok2 || '_' || "
            + d.ymd("d2")
            + f" || '_K' || {_pad('k', 7)} || '.nc' else scene1 || '_X_' || id_img2 ||"
            f" '_G0120V02_P' || {_pad('pvp', 3)} || '_K' || {_pad('k', 7)} || '.nc' end",
            "acquisition_date_img1": acquired("d1"),
            "acquisition_date_img2": acquired("d2"),
            "date_center": d.dashed(d.plus("d1", "floor(sep / cast(2 as double))"))
            + " || case when sep % 2 = 0 then 'T00:00:00' else 'T12:00:00' end",
            "date_dt": "case when k % 521 = 13 then null else cast(abs(sep) as double) + cast(case when k % 4 = 0 then 0.5 else 0 end as"
            " double) end",
            "roi_valid_percentage": "case when k % 547 = 19 then null else cast(pvp as double) +"
            " cast(case when k % 6 = 0 and pvp < 100 then 0.5 else 0 end as double) end",
            "flight_direction_img1": "case when c % 3 = 1 then case when k % 2 = 0 then"
            " 'ascending' else 'descending' end end",
            "path_img1": "path",
            "row_img1": "row",
            "path_img2": "case when k % 10 = 0 then 0 else path end",
            "row_img2": "row",
            "date_created": "case when k % 17 = 0 then null else '2023-0' ||"
            " cast(1 + k % 9 as string) || '-1' || cast(k % 10 as string) || 'T10:00:00' end",
            "date_updated": "case k % 3 when 0 then null when 1 then 'unknown' else '2024-0' ||"
            " cast(1 + k % 9 as string) || '-2' || cast(k % 9 as string) || 'T01:02:03' end",
        },
        {
            "url": f"case when k % 2 = 0 then 's3://{STORE}/' else"
            f" 'https://{STORE}.s3.amazonaws.com/' end || prefix || '/' || path_name",
        },
    ]


GRANULE_COLUMNS = (
    "k", "c", "site", "prefix", "path_name", "url", "id_img1", "id_img2", "acquisition_date_img1",
    "acquisition_date_img2", "date_center", "date_dt", "roi_valid_percentage",
    "flight_direction_img1", "path_img1", "row_img1", "path_img2", "row_img2", "date_created",
    "date_updated", "x_first", "x_last", "y_first", "y_last", "geotransform", "spatial_epsg",
)


_KEYS = {"k": T.LongType(), "c": T.LongType()}
GRANULE_TABLE = T.StructType(
    [
        T.StructField(n, GRANULE[n].dataType if n in GRANULE.names else _KEYS.get(n, T.StringType()))
        for n in GRANULE_COLUMNS
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layered(df: DataFrame, layers: list[dict[str, str]]) -> DataFrame:
    for layer in layers:
        df = df.selectExpr("*", *[f"{e} as {n}" for n, e in layer.items()])
    return df


def layered_sql(source: str, layers: list[dict[str, str]], columns) -> str:
    """The same layers as one nested statement."""
    for layer in layers:
        source = "(select *, " + ", ".join(f"{e} as {n}" for n, e in layer.items()) + (
            f" from {source})"
        )
    return f"select {', '.join(columns)} from {source}"


def built_granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    tasks = spark.sparkContext.defaultParallelism
    if len(orders.inputFiles()) < tasks:  # a single small file would be worked off by one task
        orders = orders.repartition(tasks)
    return layered(orders, granule_layers(SPARK)).select(*GRANULE_COLUMNS)


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a table that the first query of the application writes and later ones read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        configure(spark)
        path = new_path(spark, name)
        with frugal(spark):
            write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The granule attribute table, in files of at most 20,000 rows so that reads are parallel."""
    path = _written(
        spark,
        sf_dir,
        "granules",
        lambda p: built_granules(spark, sf_dir).write.option("maxRecordsPerFile", 20_000).parquet(p),
    )
    return spark.read.schema(GRANULE_TABLE).parquet(path)


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Granules as items with their error column, not yet written."""
    return derive_items(granules(spark, sf_dir))


def catalog_path(spark: SparkSession, sf_dir: str) -> str:
    """The good items, written as a cell-partitioned catalog."""
    return _written(
        spark,
        sf_dir,
        "catalog",
        lambda p: write_catalog(catalog_columns(good_items(derived(spark, sf_dir))), p),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_catalog(spark, catalog_path(spark, sf_dir))


def granules_sql() -> str:
    return layered_sql("orders", granule_layers(DUCK), GRANULE_COLUMNS)


# Query geometries: one pentagon, or a box with a hole, per supplier, near the sites.
def roi_layers() -> list[dict[str, str]]:
    return [
        {
            "roi_id": "s_suppkey",
            "lon0": "case s_suppkey % 5 when 0 then cast(-55 as double) when 1 then"
            " cast(-75 as double) when 2 then cast(81 as double) when 3 then cast(-146 as double)"
            " else cast(-74 as double) end"
            " + ((s_suppkey * 7919) % 900) / cast(100 as double)",
            "lat0": "case s_suppkey % 5 when 0 then cast(61 as double) when 1 then"
            " cast(-72 as double) when 2 then cast(28 as double) when 3 then cast(58 as double)"
            " else cast(-50 as double) end"
            " + ((s_suppkey * 104729) % 700) / cast(100 as double)",
            "w": "(20 + (s_suppkey * 31) % 180) / cast(100 as double)",
        }
    ]


# Outer ring in units of the width from the first corner, and the hole.
ROI_OUTER = ((0, 0), (1, 0), (1.25, 0.5), (0.5, 1.25), (-0.25, 0.5), (0, 0))
ROI_HOLE = ((0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25))


def rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(roi_id, chains, bbox)``; every third geometry has a hole."""

    def ring(points) -> str:
        ends = ", ".join(
            f"struct(lon0 + w * {float(x)}D as lon, lat0 + w * {float(y)}D as lat)"
            for x, y in points
        )
        return f"array({ends})"

    outer = f"struct(true as area, {ring(ROI_OUTER)} as points)"
    hole = f"struct(true as area, {ring(ROI_HOLE)} as points)"
    box = (
        "struct(lon0 + w * -0.25D as xmin, lat0 as ymin,"
        " lon0 + w * 1.25D as xmax, lat0 + w * 1.25D as ymax)"
    )
    return layered(table(spark, sf_dir, "supplier"), roi_layers()).selectExpr(
        "roi_id",
        f"case when roi_id % 3 = 0 then array({outer}, {hole}) else array({outer}) end as chains",
        f"{box} as bbox",
    )


def roi_edges_sql() -> str:
    """Edges of all query geometries, for the checking engine."""
    rows = []
    for n, points in enumerate((ROI_OUTER, ROI_HOLE)):
        for m, ((x1, y1), (x2, y2)) in enumerate(zip(points, points[1:], strict=False)):
            rows.append(f"({n}, {m}, {x1}, {y1}, {x2}, {y2})")
    return f"""select roi_id, e.ring, e.m,
 lon0 + w * cast(e.x1 as double) as x1, lat0 + w * cast(e.y1 as double) as y1,
 lon0 + w * cast(e.x2 as double) as x2, lat0 + w * cast(e.y2 as double) as y2
from ({layered_sql("supplier", roi_layers(), ("roi_id", "lon0", "lat0", "w"))}) r
cross join (values {", ".join(rows)}) e(ring, m, x1, y1, x2, y2)
where e.ring = 0 or roi_id % 3 = 0"""
