"""Queries that search the written catalog."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tilewright.operators import filters as fl
from tilewright.operators import search as se
from tilewright.operators.numbering import batches
from tilewright.plans import fixtures as fx
from tilewright.plans import reference_sql as rs
from tilewright.plans.registry import query
from tilewright.plans.scalar_queries import FLAT_ITEM_SQL, flat_items
from tilewright.plans.spatial_queries import hex_cells
from tilewright.sources import catalog as cat
from tilewright.sources import geoparquet as geo
from tilewright.sources import tables
from tilewright.staging import new_path, stage

# Regions of interest of the searches.
GREENLAND = {
    "type": "Polygon",
    "coordinates": [[[-50.0, 62.0], [-40.0, 61.0], [-38.5, 66.0], [-45.0, 70.0], [-50.0, 62.0]]],
}
NORTH = {"type": "Polygon", "coordinates": [[[-150, 60], [-20, 58], [-15, 75], [-150, 72], [-150, 60]]]}
BOX = (-150.0, 58.5, -40.0, 70.0)
VALID_POLAR = [
    {"op": ">=", "args": [{"property": "percent_valid_pixels"}, 1]},
    {"op": "=", "args": [{"property": "proj:code"}, "EPSG:3413"]},
]
INTERVAL = "1996-01-01T00:00:00Z/1999-12-31T23:59:59Z"
INTERVAL_SQL = "datetime between timestamp '1996-01-01' and timestamp '1999-12-31 23:59:59'"
POLAR_SQL = "percent_valid_pixels >= 1 and proj_code = 'EPSG:3413'"


def meets_sql(geometry: dict, select: str) -> str:
    """Items meeting one polygon, all edge pairs and points tested."""
    rings = geometry["coordinates"]
    edges = ", ".join(
        f"({n}, {i}, {a[0]}::double, {a[1]}::double, {b[0]}::double, {b[1]}::double)"
        for n, ring in enumerate(rings)
        for i, (a, b) in enumerate(zip(ring, ring[1:], strict=False))
    )
    lon, lat = [p[0] for ring in rings for p in ring], [p[1] for ring in rings for p in ring]
    item, roi = ("e.ax", "e.ay", "e.bx", "e.by_"), ("q.x1", "q.y1", "q.x2", "q.y2")
    return f"""with {rs.ITEM_CTES}, {rs.EDGE_CTES},
q as (select * from (values {edges}) v(n, m, x1, y1, x2, y2)),
near as materialized (select k from items where xmin <= {max(lon)} and xmax >= {min(lon)}
  and ymin <= {max(lat)} and ymax >= {min(lat)}),
meets as (select distinct e.k from near join edges e on e.k = near.k cross join q
    where {rs.touch(item, roi)}
  union select p.k from near join placed p on p.k = near.k and p.i = 0 cross join q
    group by p.k, p.lon, p.lat having sum({rs.crossing("p.lon", "p.lat", roi)}) % 2 = 1
  union select e.k from near join edges e on e.k = near.k cross join q where q.m = 0
    group by e.k, q.n, q.x1, q.y1 having sum({rs.crossing("q.x1", "q.y1", item)}) % 2 = 1),
found as (select * from items where k in (select k from meets)) {select}"""


@query(
    meets_sql(
        NORTH, f"select href from found where {INTERVAL_SQL} and percent_valid_pixels >= 20"
    )
)
def search_polygon(spark, sf):
    """The flagship: polygon, interval and a property, to sorted links."""
    return se.search_hrefs(
        spark,
        fx.catalog_path(spark, sf),
        intersects=NORTH,
        datetime=INTERVAL,
        filters=[{"op": ">=", "args": [{"property": "percent_valid_pixels"}, 20]}],
    )


@query(meets_sql(GREENLAND, f"select href from found where {POLAR_SQL}"))
def search_greenland(spark, sf):
    return se.search_hrefs(
        spark, fx.catalog_path(spark, sf), intersects=GREENLAND, filters=VALID_POLAR
    )


@query(
    meets_sql(
        GREENLAND,
        f"""select href from found where {POLAR_SQL}
 and cell in ('N60W050', 'N60W040', 'N70W050', 'N70W040')""",
    )
)
def search_home_cells(spark, sf):
    """As directory-based search does it: only cells that the polygon touches are opened."""
    return se.search_hrefs(
        spark, fx.catalog_path(spark, sf), intersects=GREENLAND, filters=VALID_POLAR, prune="home"
    )


@query(meets_sql(GREENLAND, f"select href from found where {POLAR_SQL}"))
def search_unpruned(spark, sf):
    return se.search_hrefs(
        spark, fx.catalog_path(spark, sf), intersects=GREENLAND, filters=VALID_POLAR, prune="none"
    )


_BOX_RING = [[BOX[0], BOX[1]], [BOX[2], BOX[1]], [BOX[2], BOX[3]], [BOX[0], BOX[3]], [BOX[0], BOX[1]]]


@query(meets_sql({"coordinates": [_BOX_RING]}, "select id, mission, cell from found"))
def search_bbox(spark, sf):
    rows = se.search(spark, fx.catalog_path(spark, sf), bbox="-150.0,58.5,-40.0,70.0")
    return rows.select("id", "mission", "cell")


@query(
    rs.items(
        "select count(*) as n, sum(case when year < 1998 then 1 else 0 end)::bigint as early from"
        " items where datetime >= timestamp '1997-06-01' and datetime <= timestamp '1998-06-30'"
    )
)
def search_interval(spark, sf):
    found = se.search(spark, fx.catalog_path(spark, sf), datetime="1997-06-01/1998-06-30")
    return found.agg(F.count("*").alias("n"), F.count_if(F.col("year") < 1998).alias("early"))


@query(
    rs.items(
        "select 'from' as kind, id from items where datetime >= timestamp '2001-03-01' union all"
        " select 'until', id from items where datetime <= timestamp '1995-03-01' union all"
        " select 'instant', id from items where datetime = timestamp '1998-05-05 12:00:00'"
    )
)
def open_intervals(spark, sf):
    path = fx.catalog_path(spark, sf)
    kinds = {"from": "2001-03-01/..", "until": "/1995-03-01", "instant": "1998-05-05T12:00:00Z"}
    parts = [
        se.search(spark, path, datetime=i).select(F.lit(n).alias("kind"), "id")
        for n, i in kinds.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


TREE = {
    "op": "or",
    "args": [
        {
            "op": "and",
            "args": [
                {"op": "=", "args": [{"property": "sat:orbit_state"}, "ascending"]},
                {"op": "<=", "args": [{"property": "dt_days"}, 8]},
            ],
        },
        {"op": "not", "args": [{"op": "<>", "args": [{"property": "platform"}, "LC09"]}]},
        {"op": "<", "args": [99, {"property": "percent_valid_pixels"}]},
        {},
    ],
}


@query(
    rs.items(
        "select id, platform, orbit_state, date_dt, percent_valid_pixels from items where"
        " (orbit_state = 'ascending' and date_dt <= 8) or platform = 'LC09'"
        " or percent_valid_pixels > 99"
    )
)
def filter_tree(spark, sf):
    found = se.search(spark, fx.catalog_path(spark, sf), filters=TREE)
    orbit = F.col("`sat:orbit_state`").alias("orbit_state")
    return found.select("id", "platform", orbit, "date_dt", "percent_valid_pixels")


@query(
    rs.items(
        "select op, count(*) as n from (select unnest(list_filter(["
        " case when date_dt = 30 then '=' end, case when date_dt = 31 then '==' end,"
        " case when date_dt >= 300 then '>=' end, case when date_dt <= 20 then '<=' end,"
        " case when date_dt > 300 then '>' end, case when date_dt < 20 then '<' end,"
        " case when date_dt <> 30 then '!=' end, case when date_dt <> 31 then '<>' end],"
        " lambda o: o is not null)) as op from items) group by op"
    )
)
def filter_operators(spark, sf):
    """Every comparison once, counted in one pass over the catalog."""
    values = {"=": 30, "==": 31, ">=": 300, "<=": 20, ">": 300, "<": 20, "!=": 30, "<>": 31}
    tests = [
        F.when(fl.predicate({"op": op, "args": [{"property": "date_dt"}, v]}), F.lit(op))
        for op, v in values.items()
    ]
    hits = fx.items(spark, sf).select(F.explode(F.array_compact(F.array(*tests))).alias("op"))
    return hits.groupBy("op").agg(F.count("*").alias("n"))


@query(
    rs.items(
        "select id from items where percent_valid_pixels >= 50 and proj_code = 'EPSG:3031'"
        " and collection = 'granules' order by id limit 100"
    )
)
def first_items(spark, sf):
    """At most 100 items, in order of id."""
    found = se.search(
        spark,
        fx.catalog_path(spark, sf),
        filters=[
            {"op": ">=", "args": [{"property": "percent_valid_pixels"}, 50]},
            {"op": "=", "args": [{"property": "proj:code"}, "EPSG:3031"]},
            {"op": "=", "args": [{"property": "platform"}, None]},
        ],
        collection="granules",
        max_items=100,
    )
    return found.select("id")


@query(rs.items("select distinct href from items"))
def all_hrefs(spark, sf):
    return fl.data_hrefs(fx.items(spark, sf)).distinct()


@query(
    meets_sql(NORTH, "select mission, cell, count(*) as n from found group by mission, cell")
)
def search_by_prefix(spark, sf):
    return se.matches_by_partition(
        se.search(spark, fx.catalog_path(spark, sf), intersects=NORTH)
    )


@query(
    meets_sql(
        GREENLAND,
        """select id, cast((row_number() over (order by id) - 1) // 50 as bigint) as page from found""",
    )
)
def search_pages(spark, sf):
    found = se.search(spark, fx.catalog_path(spark, sf), intersects=GREENLAND)
    return batches(stage(found.select("id"), "found"), [], ["id"], 50, "page")


@query(rs.items("select count(*) as n from items"))
def catalog_count(spark, sf):
    return cat.count_items(spark, fx.catalog_path(spark, sf))


@query(rs.items(f"select {FLAT_ITEM_SQL} from items"))
def catalog_readback(spark, sf):
    return flat_items(fx.items(spark, sf))


@query(
    rs.items(
        "select mission, cell, year, count(*) as n, min(xmin) as xmin, min(ymin) as ymin,"
        " max(xmax) as xmax, max(ymax) as ymax from items group by mission, cell, year"
    )
)
def partition_extents(spark, sf):
    extents = cat.read_extents(spark, fx.catalog_path(spark, sf))
    return extents.select("mission", "cell", "year", "n", "bbox.*")


@query(
    rs.items(
        "select id, platform, case when mission = 'sentinel1' then orbit_state end as orbit_state,"
        " case when mission = 'landsatOLI' then scene_1_path_row end as path_row from items"
    )
)
def merged_schemas(spark, sf):
    """Files with different columns read as one table by column name, by what their writes recorded."""
    items, path = fx.items(spark, sf), new_path(spark, "mixed")
    orbit = F.col("`sat:orbit_state`").alias("orbit_state")
    row = F.col("scene_1_path_row").alias("path_row")
    extra = {"landsatOLI": [row], "sentinel1": [orbit], "sentinel2": []}
    for mission, columns in extra.items():
        part = items.filter(F.col("mission") == mission).select("id", "platform", *columns)
        geo.write_directory(part, path, mission)
    read = geo.read_directories(spark, [f"{path}/{m}" for m in extra], base=path)
    return read.select("id", "platform", "orbit_state", "path_row")


@query(meets_sql(GREENLAND, f"select href from found where {POLAR_SQL}"))
def href_list(spark, sf):
    """Links written one per line and read again."""
    path = new_path(spark, "hrefs")
    tables.write_hrefs(search_greenland(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("href"))


HOLED = {
    "type": "Polygon",
    "coordinates": [
        NORTH["coordinates"][0],
        [[-60, 62], [-30, 62], [-30, 71], [-60, 71], [-60, 62]],
    ],
}


@query(meets_sql(HOLED, "select id, date_dt from found"))
def search_with_hole(spark, sf):
    """Items around a hole in the query polygon."""
    found = se.search(spark, fx.catalog_path(spark, sf), intersects=HOLED)
    return found.select("id", "date_dt")


LINE = {"type": "LineString", "coordinates": [[-55, 60], [-40, 75]]}


@query(
    f"""with {rs.ITEM_CTES}, {rs.EDGE_CTES} select distinct id from items join edges e on e.k = items.k
 where {rs.touch(("e.ax", "e.ay", "e.bx", "e.by_"), ("-55::double", "60::double", "-40::double", "75::double"))}"""
)
def search_along_line(spark, sf):
    """Items that a flight line touches."""
    return se.search(spark, fx.catalog_path(spark, sf), intersects=LINE).select("id")


@F.arrow_udf(BinaryType())
def _polygon_wkb(rings: pa.Array) -> pa.Array:
    """Well-known binary of rings that all have as many points."""
    n = len(rings.flatten()) // max(len(rings), 1)
    x, y = (c.to_numpy() for c in rings.flatten().flatten())
    head = np.frombuffer(struct.pack("<BIII", 1, 3, 1, n), np.uint8)
    points = np.stack([x, y], axis=1).reshape(len(rings), -1).astype("<f8").view(np.uint8)
    body = np.hstack([np.broadcast_to(head, (len(rings), 13)), points])
    return pa.array([row.tobytes() for row in body], pa.binary())


def _plain_directories(spark, rows, keys, name):
    """Rows in directories named by the values of the keys alone, of which there are as many as a grid has."""
    path = new_path(spark, name)
    rows.hint("rebalance", *[F.col(k) for k in keys]).write.partitionBy(*keys).parquet(path)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def strip(parent, depth):
        for child in cat.child_directories(spark, parent):
            plain = f"{parent}/{child.partition('=')[2]}"
            files.rename(fs_path(f"{parent}/{child}"), fs_path(plain))
            if depth > 1:
                strip(plain, depth - 1)

    strip(path, len(keys))
    return path


@query(
    meets_sql(
        GREENLAND,
        f"""select href from found where {POLAR_SQL}
 and cell in ('N60W050', 'N60W040', 'N70W050', 'N70W040')""",
    )
)
def directory_search(spark, sf):
    """Geoparquet directories by grid cell; assets stored as a struct."""
    data = F.struct(F.col("assets")["data"].alias("data"), F.col("assets")["overview"].alias("overview"))
    rows = fx.items(spark, sf).withColumns({"geometry": _polygon_wkb(F.col("ring")), "assets": data})
    base = _plain_directories(spark, rows.drop("ring", "bbox", "year"), ["mission", "cell"], "geo")
    return geo.search_latlon(spark, base, GREENLAND, filters=VALID_POLAR)


@query(
    meets_sql(
        GREENLAND,
        f"""select distinct href from found where {POLAR_SQL} and c in (select c_custkey from
 (select c_custkey, ((c_custkey * 7919) % 18000) / cast(100 as double) - 150 as hx,
  ((c_custkey * 104729) % 15000) / cast(100 as double) - 75 as hy,
  cast(2 + c_custkey % 7 as double) / 2 as half from customer)
 where hx - half <= -38.5 and hx + half >= -50 and hy - half <= 70 and hy + half >= 61)""",
    )
)
def hex_search(spark, sf):
    """Geoparquet directories by cell number, found by a cell table; assets stored as text."""
    good = fx.derived(spark, sf).filter("error is null")
    rows = good.withColumns({"geometry": _polygon_wkb(F.col("ring")), "assets": F.to_json("assets")})
    rows = rows.drop("ring", "bbox", "cell").withColumnRenamed("c", "cell")
    base = new_path(spark, "hex")
    geo.write_cells(rows, base)
    return geo.search_hex(spark, base, hex_cells(spark, sf), GREENLAND, filters=VALID_POLAR)


FAR_SIDE = {"type": "Polygon", "coordinates": [[[170, 50], [200, 50], [200, 72], [170, 72], [170, 50]]]}
_BOTH_SIDES = {"coordinates": [[[x - turn, y] for x, y in FAR_SIDE["coordinates"][0]] for turn in (0, 360)]}


@query(meets_sql(_BOTH_SIDES, "select id, xmax - xmin > 180 as crosses from found"))
def search_over_meridian(spark, sf):
    """A box that reaches over 180 degrees: items on both sides, and those that cross it themselves."""
    found = se.search(spark, fx.catalog_path(spark, sf), intersects=FAR_SIDE)
    return found.select("id", (F.col("bbox.xmax") - F.col("bbox.xmin") > 180).alias("crosses"))
