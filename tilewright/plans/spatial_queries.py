"""Queries on footprints, boxes, cells and polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilewright.functions import cells, geometry
from tilewright.functions.footprint import corners, extent
from tilewright.functions.numbers import round_scaled
from tilewright.functions.projection import lonlat
from tilewright.operators import derive, quality
from tilewright.operators.search import search_granule
from tilewright.operators.spatial_join import cover_by_table, spatial_join
from tilewright.plans import fixtures as fx
from tilewright.plans import reference_sql as rs
from tilewright.plans.registry import query
from tilewright.sources.catalog import read_extents


def _good(spark, sf):
    return fx.derived(spark, sf).filter(F.col("error").isNull())


@query(
    rs.granules(
        """select k, x_first - px / 2 as minx, x_last + px / 2 as maxx, y_last + py / 2 as miny,
 y_first - py / 2 as maxy from g where geotransform is not null"""
    )
)
def projected_extents(spark, sf):
    placed = fx.granules(spark, sf).filter(F.col("geotransform").isNotNull())
    return placed.select("k", *[c.alias(n) for n, c in extent().items()])


@query(
    f"""with {rs.GRANULE_CTES},
p as (select k, spatial_epsg as epsg, x_first as x, y_first as y from g where {rs.SUPPORTED}),
{rs.lonlat_ctes("p", "ll")}
select k, {rs.rounded("lon", 6)} as lon, {rs.rounded("lat", 6)} as lat from ll"""
)
def point_lonlat(spark, sf):
    place = lonlat(F.col("spatial_epsg"), F.col("x_first"), F.col("y_first"))
    placed = fx.granules(spark, sf).select("k", place.alias("p")).filter(F.col("p").isNotNull())
    return placed.select(
        "k", *[round_scaled(F.col(f"p.{n}"), 6).alias(n) for n in ("lon", "lat")]
    )


@query(
    rs.items("select k, cast(i as int) as i, lon, lat from ring join"
             " (select k as gk, proj_code from items) on k = gk"
             " where i < 17 and proj_code in ('EPSG:3413', 'EPSG:3031')")
)
def footprint_polar(spark, sf):
    polar = _good(spark, sf).filter(F.col("`proj:code`").isin("EPSG:3413", "EPSG:3031"))
    return polar.select("k", F.posexplode("ring").alias("i", "p")).select("k", "i", "p.lon", "p.lat")


@query(
    rs.items("select k, cast(i as int) as i, lon, lat from ring join"
             " (select k as gk, proj_code from items) on k = gk"
             " where i < 17 and proj_code not in ('EPSG:3413', 'EPSG:3031')")
)
def footprint_utm(spark, sf):
    utm = _good(spark, sf).filter(~F.col("`proj:code`").isin("EPSG:3413", "EPSG:3031"))
    return utm.select("k", F.posexplode("ring").alias("i", "p")).select("k", "i", "p.lon", "p.lat")


@query(rs.items("select k, xmin, ymin, xmax, ymax, longitude, latitude from items"))
def footprint_bbox(spark, sf):
    return _good(spark, sf).select("k", "bbox.*", "longitude", "latitude")


@query(
    rs.items("""select k, case i when 12 then 'UL' when 8 then 'UR' when 4 then 'LR' else 'LL' end
 as corner, lon, lat from ring where i in (0, 4, 8, 12)""")
)
def footprint_corners(spark, sf):
    named = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("UL", "UR", "LR", "LL")]), corners(F.col("ring"))
    )
    rows = _good(spark, sf).select("k", F.explode(named).alias("corner", "p"))
    return rows.select("k", "corner", "p.lon", "p.lat")


@query(
    f"""with {rs.GRANULE_CTES},
p as (select k, spatial_epsg as epsg, e.hi, case when e.hi then greatest(x_first, x_last)
 else least(x_first, x_last) end as x, case when e.hi then greatest(y_first, y_last)
 else least(y_first, y_last) end as y
 from g cross join (values (true), (false)) e(hi) where {rs.SUPPORTED}),
{rs.lonlat_ctes("p", "ll")}
select url, max({rs.rounded("lon", 6)}) filter (not hi and not isnan(x)) as xmin,
 max({rs.rounded("lat", 6)}) filter (not hi and not isnan(x)) as ymin,
 max({rs.rounded("lon", 6)}) filter (hi and not isnan(x)) as xmax, max({rs.rounded("lat", 6)}) filter (hi and not isnan(x)) as ymax
from ll join (select k as gk, url from g) on k = gk group by url"""
)
def search_boxes(spark, sf):
    boxes = search_granule(fx.granules(spark, sf)).filter(F.col("bbox.xmin").isNotNull())
    return boxes.select(
        "url", *[round_scaled(F.col(f"bbox.{n}"), 6).alias(n) for n in ("xmin", "ymin", "xmax", "ymax")]
    )


@query(
    """select s_suppkey as roi_id, cast(s_suppkey % 90 as double) as xmin,
 cast(s_suppkey % 40 as double) + 0.25 as ymin, cast(s_suppkey % 90 as double) + 4.5 as xmax,
 cast(s_suppkey % 40 as double) + 3.5 as ymax, 5 as n_points from supplier"""
)
def geojson_boxes(spark, sf):
    """GeoJSON feature texts, to their boxes, to closed rings of the boxes."""
    k = F.col("s_suppkey")
    x, y = (k % 90).cast("double"), (k % 40).cast("double")
    corners = [(x, y + 1.0), (x + 4.5, y + 0.25), (x + 2.0, y + 3.5), (x, y + 1.0)]
    text = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"Polygon","coordinates":['),
        _ring_text(corners),
        F.lit("]}}"),
    )
    shapes = fx.table(spark, sf, "supplier").select(
        k.alias("roi_id"), geometry.geojson_shape(text)["bbox"].alias("bbox")
    )
    box = F.col("bbox")
    closed = geometry.box_ring(box["xmin"], box["ymin"], box["xmax"], box["ymax"])
    return shapes.select("roi_id", "bbox.*", F.size(closed).alias("n_points"))


def _ring_text(points):
    pairs = [F.concat(F.lit("["), x, F.lit(","), y, F.lit("]")) for x, y in points]
    return F.concat(F.lit("["), F.concat_ws(",", *pairs), F.lit("]"))


@query(
    """with s as (select s_suppkey as roi_id, s_suppkey % 6 as kind,
   cast(s_suppkey % 90 as double) as x, cast(s_suppkey % 40 as double) as y from supplier)
 select roi_id, case kind when 0 then 2 when 1 then 2 when 2 then 3 when 3 then 1 end as n_chains,
  case kind when 0 then 2 when 1 then 2 when 2 then 2 when 3 then 0 end as n_areas,
  case kind when 0 then 8 when 1 then 8 when 2 then 9 when 3 then 2 end as n_points,
  case when kind < 4 then x end as xmin, case when kind < 4 then y end as ymin,
  case kind when 0 then x + 4 when 1 then x + 9 when 2 then x + 9 when 3 then x + 4 end as xmax,
  case kind when 3 then y + 3 when 0 then y + 4 when 1 then y + 4 when 2 then y + 4 end as ymax,
  kind >= 4 as faulty from s"""
)
def geojson_shapes(spark, sf):
    """A hole, several parts, a collection, a line; a ring left open and a text without geometry."""
    k = F.col("s_suppkey")
    x, y = (k % 90).cast("double"), (k % 40).cast("double")

    def triangle(dx, size):
        return [(x + dx, y), (x + dx + size, y), (x + dx, y + size), (x + dx, y)]

    big, small, far = (_ring_text(triangle(d, n)) for d, n in ((0.0, 4.0), (0.5, 1.0), (5.0, 4.0)))
    line = _ring_text([(x, y), (x + 4.0, y + 3.0)])
    opened = _ring_text([(x, y), (x + 4.0, y), (x, y + 4.0), (x + 1.0, y + 1.0)])

    def typed(kind, name, inner):
        return F.concat(F.lit(f'{{"type":"{kind}","{name}":'), inner, F.lit("}"))

    def polygon(*rings):
        return F.concat(F.lit("["), F.concat_ws(",", *rings), F.lit("]"))

    parts = typed("MultiPolygon", "coordinates", polygon(polygon(big), polygon(far)))
    point = typed("Point", "coordinates", F.concat(F.lit("["), x, F.lit(","), y, F.lit("]")))
    features = [F.concat(F.lit('{"type":"Feature","geometry":'), g, F.lit("}")) for g in (parts, point)]
    text = (
        F.when(k % 6 == 0, typed("Polygon", "coordinates", polygon(big, small)))
        .when(k % 6 == 1, parts)
        .when(k % 6 == 2, typed("FeatureCollection", "features", polygon(*features)))
        .when(k % 6 == 3, typed("LineString", "coordinates", line))
        .when(k % 6 == 4, typed("Polygon", "coordinates", polygon(opened)))
        .otherwise(F.lit('{"type":"Feature"}'))
    )
    shapes = fx.table(spark, sf, "supplier").select(
        k.alias("roi_id"), geometry.geojson_shape(text).alias("shape")
    )
    chains = F.col("shape.chains")
    points = F.aggregate(chains, F.lit(0), lambda n, c: n + F.size(c["points"]))
    return shapes.select(
        "roi_id",
        F.when(chains.isNotNull(), F.size(chains)).alias("n_chains"),
        F.when(chains.isNotNull(), F.size(F.filter(chains, lambda c: c["area"]))).alias("n_areas"),
        points.alias("n_points"),
        "shape.bbox.*",
        F.col("shape.problem").isNotNull().alias("faulty"),
    )


# Squares of the grid against the query geometries, by edges and by points inside.
_SQUARE = [("sx0", "sy0", "sx1", "sy0"), ("sx1", "sy0", "sx1", "sy1"),
           ("sx1", "sy1", "sx0", "sy1"), ("sx0", "sy1", "sx0", "sy0")]
_ROI_EDGE = ("x1", "y1", "x2", "y2")
COVER_CTES = f"""{rs.ROI_CTES},
sq as (select roi_id, lat_c, lon_c, lon_c - 5 as sx0, lat_c - 5 as sy0, lon_c + 5 as sx1,
  lat_c + 5 as sy1, rxmin, rymin from roi_box
  cross join (select unnest(generate_series(-90, 90, 10)) as lat_c)
  cross join (select unnest(generate_series(-180, 180, 10)) as lon_c)
  where rxmin <= lon_c + 5 and rxmax >= lon_c - 5 and rymin <= lat_c + 5 and rymax >= lat_c - 5),
cover as (select roi_id, lat_c, lon_c from sq join roi_edges using (roi_id)
  group by roi_id, lat_c, lon_c, sx0, sy0, sx1, sy1
  having bool_or({" or ".join(rs.touch(s, _ROI_EDGE) for s in _SQUARE)})
   or sum({rs.crossing("sx0", "sy0", _ROI_EDGE)}) % 2 = 1
   or bool_or(x1 between sx0 and sx1 and y1 between sy0 and sy1))"""


@query(
    f"""with {COVER_CTES} select distinct roi_id, m.mission as mission,
 {rs.cell("lat_c", "lon_c")} as cell from cover
 cross join (values ('landsatOLI'), ('sentinel1'), ('sentinel2')) m(mission)"""
)
def cell_cover(spark, sf):
    return cells.with_missions(cells.cell_cover(fx.rois(spark, sf)))


@query(
    f"with {rs.ITEM_CTES}, {COVER_CTES} select distinct c.roi_id, i.mission, i.cell from"
    f" (select distinct roi_id, {rs.cell('lat_c', 'lon_c')} as cell from cover) c"
    " join (select distinct mission, cell from items) i on i.cell = c.cell"
)
def cells_to_open(spark, sf):
    """Covered cells that the catalog has, per query geometry."""
    have = read_extents(spark, fx.catalog_path(spark, sf)).select("mission", "cell").distinct()
    cover = cells.with_missions(cells.cell_cover(fx.rois(spark, sf)))
    return cover.join(have, ["mission", "cell"], "left_semi").select("roi_id", "mission", "cell")


# A cell table of hexagons, one per customer.
HEX = ((0.5, 0.0), (0.25, 0.5), (-0.25, 0.5), (-0.5, 0.0), (-0.25, -0.5), (0.25, -0.5), (0.5, 0.0))
HEX_SQL = """select c_custkey as cell, ((c_custkey * 7919) % 18000) / cast(100 as double) - 150 as hx,
 ((c_custkey * 104729) % 15000) / cast(100 as double) - 75 as hy,
 cast(2 + c_custkey % 7 as double) as hw from customer"""


def hex_cells(spark, sf):
    k = F.col("c_custkey")
    hundred = F.lit(100.0).cast("double")
    x = (k * 7919) % 18000 / hundred - 150
    y = (k * 104729) % 15000 / hundred - 75
    w = (2 + k % 7).cast("double")
    ring = F.array(*[F.struct((x + w * a).alias("lon"), (y + w * b).alias("lat")) for a, b in HEX])
    return fx.table(spark, sf, "customer").select(k.alias("cell"), ring.alias("ring"))


_HEX_EDGES = ", ".join(
    f"({i}, {a}, {b}, {c}, {d})"
    for i, ((a, b), (c, d)) in enumerate(zip(HEX, HEX[1:], strict=False))
)
_HEX_EDGE = ("hx1", "hy1", "hx2", "hy2")


def _mean(start: str, axis: int) -> str:
    """Mean of the hexagon's vertices, summed in their order."""
    total = "0.0::double"
    for point in HEX[:-1]:
        total = f"({total} + ({start} + hw * {point[axis]}::double))"
    return f"{total} / 6"


HEX_CTES = f"""{rs.ROI_CTES},
hexes as ({HEX_SQL}),
hex_pairs as materialized (select cell, hx, hy, hw, roi_id from hexes join roi_box
  on hx - hw * 0.5::double <= rxmax and hx + hw * 0.5::double >= rxmin
  and hy - hw * 0.5::double <= rymax and hy + hw * 0.5::double >= rymin),
hex_edges as (select cell, i, hx + hw * a::double as hx1, hy + hw * b::double as hy1,
  hx + hw * c::double as hx2, hy + hw * d::double as hy2 from hexes
  cross join (values {_HEX_EDGES}) e(i, a, b, c, d)),
hex_touch as (select distinct p.cell, p.roi_id from hex_pairs p join hex_edges h using (cell)
  join roi_edges r on r.roi_id = p.roi_id where {rs.touch(_HEX_EDGE, _ROI_EDGE)}),
hex_in as (select p.cell, p.roi_id from hex_pairs p join hex_edges h on h.cell = p.cell and h.i = 0
  join roi_edges r on r.roi_id = p.roi_id group by p.cell, p.roi_id, hx1, hy1
  having sum({rs.crossing("hx1", "hy1", _ROI_EDGE)}) % 2 = 1),
roi_in as (select p.cell, p.roi_id from hex_pairs p
  join (select roi_id, ring, x1 as fx, y1 as fy from roi_edges where m = 0) f on f.roi_id = p.roi_id
  join hex_edges h on h.cell = p.cell group by p.cell, p.roi_id, f.ring, f.fx, f.fy
  having sum({rs.crossing("f.fx", "f.fy", _HEX_EDGE)}) % 2 = 1),
hex_mean as (select *, {_mean("hx", 0)} as mx, {_mean("hy", 1)} as my from hex_pairs),
hex_mid as (select p.cell, p.roi_id from hex_mean p join roi_edges r on r.roi_id = p.roi_id
  group by p.cell, p.roi_id, mx, my having sum({rs.crossing("mx", "my", _ROI_EDGE)}) % 2 = 1
  or bool_or({rs.touch(("mx", "my", "mx", "my"), _ROI_EDGE)}))"""
HEX_MODES = {
    "overlap": "select * from hex_touch union select * from hex_in union select * from roi_in",
    "bbox_overlap": "select cell, roi_id from hex_pairs",
    "center": "select * from hex_mid",
    "full": "select cell, roi_id from hex_in except select cell, roi_id from hex_touch"
    " except select cell, roi_id from roi_in",
}


@query(
    f"with {HEX_CTES} "
    + " union all ".join(f"select '{m}' as mode, roi_id, cell from ({s})" for m, s in HEX_MODES.items())
)
def hex_cover(spark, sf):
    """Cells of a cell table that cover each query geometry, by every containment mode."""
    return cover_by_table(fx.rois(spark, sf), hex_cells(spark, sf), tuple(HEX_MODES))


@query(
    """select s_suppkey as ring_id, case s_suppkey % 5 when 1 then 'self-intersecting'
 when 2 then 'not closed' when 3 then 'too few points' end as problem from supplier"""
)
def invalid_rings(spark, sf):
    """Squares, bow ties, open and short rings around the suppliers' places."""
    k = F.col("s_suppkey")
    x, y = (k % 90).cast("double"), (k % 40).cast("double")

    def ring(steps):
        return F.array(*[F.struct((x + a).alias("lon"), (y + b).alias("lat")) for a, b in steps])

    square = ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
    rings = (
        F.when(k % 5 == 1, ring(((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))))
        .when(k % 5 == 2, ring(square[:-1]))
        .when(k % 5 == 3, ring(square[:3]))
        .otherwise(ring(square))
    )
    return fx.table(spark, sf, "supplier").select(
        k.alias("ring_id"), geometry.ring_problem(rings).alias("problem")
    )


@query(rs.item_pairs("select roi_id, id from pairs join items on items.k = pairs.k"))
def roi_join(spark, sf):
    return spatial_join(fx.items(spark, sf), fx.rois(spark, sf))


@query(rs.item_pairs("select roi_id, count(*) as n from pairs group by roi_id"))
def roi_item_counts(spark, sf):
    pairs = spatial_join(fx.items(spark, sf), fx.rois(spark, sf), rows_per_task=100_000)
    return pairs.groupBy("roi_id").agg(F.count("*").alias("n"))


@query(rs.granules("select url, error from ge where error is not null"))
def granule_errors(spark, sf):
    return derive.quarantine(fx.derived(spark, sf))


@query(
    rs.granules("select error, count(*) as n from ge where error is not null group by error")
)
def errors_by_reason(spark, sf):
    return derive.errors_by_reason(fx.derived(spark, sf))


@query(
    rs.items("""select id, unnest(list_filter([
 case when percent_valid_pixels < 0 then 'percent_valid_pixels below 0' end,
 case when percent_valid_pixels > 100 then 'percent_valid_pixels above 100' end,
 case when date_dt < 7 then 'date_dt below 7' end,
 case when date_dt > 180 then 'date_dt above 180' end], lambda r: r is not null)) as rule from items""")
)
def range_violations(spark, sf):
    return quality.range_violations(fx.items(spark, sf))
