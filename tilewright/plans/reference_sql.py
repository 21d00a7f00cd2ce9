"""Statements for the checking engine that build granules and items by plain SQL."""

from __future__ import annotations

from tilewright.plans.fixtures import granules_sql, roi_edges_sql

# Fixed values, written out here so that the statements do not follow the engine: scale times
# rectifying radius, series of the inverse projections, polar factors, sensors, assets,
# suffixes of sidecars.
KA = 6364902.166165086
LATITUDE = (0.003356551469125213, 6.5718730839601334e-06, 1.7646564004758498e-08, 5.4004820816935436e-11)
MERCATOR = (0.0008377321640600574, 5.905869567933988e-08, 1.6734888803548483e-10, 2.1677377630220365e-13)
POLAR_NORTH, POLAR_SOUTH = 8.110044095484317e-08, 8.0857763617808e-08
SENSORS = {
    "LC09": ("LANDSAT-9", "OLI"), "LO09": ("LANDSAT-9", "OLI"), "LC08": ("LANDSAT-8", "OLI"),
    "LO08": ("LANDSAT-8", "OLI"), "LE07": ("LANDSAT-7", "ETM+"), "LT05": ("LANDSAT-5", "TM"),
    "LT04": ("LANDSAT-4", "TM"), "S1A": ("SENTINEL-1", "Sentinel-1A"),
    "S1B": ("SENTINEL-1", "Sentinel-1B"), "S2A": ("SENTINEL-2", "Sentinel-2A"),
    "S2B": ("SENTINEL-2", "Sentinel-2B"),
}
ASSETS = (
    ("data", ".nc", "application/netcdf", "data"), ("overview", ".png", "image/png", "overview"),
    ("thumbnail", "_thumb.png", "image/png", "thumbnail"),
)
SUFFIXES = {"stac": ".stac.json", "premet": ".nc.premet", "spatial": ".nc.spatial"}


def instant(text: str) -> str:
    return (
        f"coalesce(try_cast({text} as timestamp), try_strptime({text}, '%Y%m%dT%H:%M:%S'))"
    )


def iso(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || case when strftime({ts}, '%f') = '000000'"
        f" then '' else strftime({ts}, '.%f') end || 'Z'"
    )


def cell(lat: str, lon: str, fold: bool = True) -> str:
    """Name of the grid cell with this centre."""
    lon_c = f"(case when ({lon}) = 180 then -180 else ({lon}) end)" if fold else f"({lon})"
    return (
        f"case when ({lat}) >= 0 then 'N' else 'S' end ||"
        f" lpad(cast(abs({lat}) as varchar), 2, '0') ||"
        f" case when {lon_c} >= 0 then 'E' else 'W' end ||"
        f" lpad(cast(abs({lon_c}) as varchar), 3, '0')"
    )


def center(degrees: str) -> str:
    return f"cast(floor((({degrees}) + 5) / 10) * 10 as int)"


def token(n: int) -> str:
    part = f"split_part(split_part(url, '/', -1), '_X_', {n})"
    return f"split_part({part}, '_', 1)"


KNOWN = "('LC09','LO09','LC08','LO08','LE07','LT05','LT04','S1A','S1B','S2A','S2B')"
SUPPORTED = (
    "(spatial_epsg in (3413, 3031) or spatial_epsg between 32601 and 32660"
    " or spatial_epsg between 32701 and 32760)"
)
ERROR = f"""case when geotransform is null or isnan(x_first) or isnan(x_last) or isnan(y_first)
 or isnan(y_last) then 'no geometry'
 when not {SUPPORTED} then 'unsupported projection'
 when start_ts is null or end_ts is null or mid_ts is null then 'bad date'
 when id_img1 is null or date_dt is null or roi_valid_percentage is null then 'missing attribute'
 when split_part(id_img1, '_', 1) not in {KNOWN} then 'unexpected platform'
 when {token(1)} not in {KNOWN} then 'unexpected sensor of image 1'
 when {token(2)} not in {KNOWN} then 'unexpected sensor of image 2' end"""


def lonlat_ctes(source: str, out: str) -> str:
    """CTEs from ``source`` with ``epsg, x, y`` to ``out`` with ``lon, lat`` unrounded."""

    def series(coefficients, outer, inner, first, second):
        return " - ".join(
            [""]
            + [
                f"cast({c!r} as double) * {outer}({2 * (j + 1)} * {first})"
                f" * {inner}({2 * (j + 1)} * {second})"
                for j, c in enumerate(coefficients)
            ]
        )

    geodetic = " + ".join(
        ["chi"]
        + [
            f"cast({c!r} as double) * sin({2 * (j + 1)} * chi)"
            for j, c in enumerate(LATITUDE)
        ]
    )
    return f"""
{out}_a as (select *, epsg in (3413, 3031) as polar,
   (y - case when epsg // 100 = 327 then cast(10000000 as double) else cast(0 as double) end)
     / cast({KA!r} as double) as xi,
   (x - cast(500000 as double)) / cast({KA!r} as double) as eta from {source}),
{out}_b as (select *,
   case when polar then cast(0 as double) else xi{series(MERCATOR, "sin", "cosh", "xi", "eta")} end as xi1,
   case when polar then cast(0 as double) else eta{series(MERCATOR, "cos", "sinh", "xi", "eta")} end as eta1
   from {out}_a),
{out}_c as (select *, case when polar then pi() / 2 - 2 * atan(sqrt(x * x + y * y)
     * case epsg when 3413 then cast({POLAR_NORTH!r} as double)
       else cast({POLAR_SOUTH!r} as double) end)
   else asin(sin(xi1) / cosh(eta1)) end as chi,
   case when epsg = 3413 then -45 + degrees(atan2(x, -y))
     when epsg = 3031 then degrees(atan2(x, y))
     else (6 * (epsg % 100) - 183) + degrees(atan2(sinh(eta1), cos(xi1))) end as lon0
   from {out}_b),
{out} as (select *, case when lon0 < -180 then lon0 + 360 when lon0 > 180 then lon0 - 360
     else lon0 end as lon,
   case when epsg = 3031 then -1 else 1 end * degrees({geodetic}) as lat from {out}_c)"""


def _ring() -> str:
    """Points of the ring: per side the corner it starts from, and quarters of the way on."""
    sides = (("minx", "miny", "maxx", "miny"), ("maxx", "miny", "maxx", "maxy"),
             ("maxx", "maxy", "minx", "maxy"), ("minx", "maxy", "minx", "miny"))
    rows = [
        f"select k, epsg, {4 * side + step} as i, {x0} + cast({step / 4} as double) * ({x1} - {x0}) as x,"
        f" {y0} + cast({step / 4} as double) * ({y1} - {y0}) as y from ext"
        for side, (x0, y0, x1, y1) in enumerate(sides)
        for step in range(4)
    ]
    return " union all ".join([*rows, "select k, epsg, 16, minx, miny from ext"])


def rounded(e: str, places: int = 4) -> str:
    scale = f"cast({10**places} as double)"
    return f"round_even(({e}) * {scale}, 0) / {scale}"


GRANULE_CTES = f"""g0 as ({granules_sql()}),
g as (select *, {instant("acquisition_date_img1")} as start_ts,
  {instant("acquisition_date_img2")} as end_ts, {instant("date_center")} as mid_ts,
  {instant("date_created")} as created_ts,
  coalesce({instant("date_updated")}, {instant("date_created")}) as updated_ts,
  try_cast(split_part(geotransform, ' ', 2) as double) as px,
  try_cast(split_part(geotransform, ' ', 6) as double) as py from g0),
ge as (select *, {ERROR} as error from g)"""

ITEM_CTES = f"""{GRANULE_CTES},
ext as (select k, spatial_epsg as epsg, x_first - px / 2 as minx, x_last + px / 2 as maxx,
  y_last + py / 2 as miny, y_first - py / 2 as maxy, (x_first + x_last) / 2 as cx,
  (y_first + y_last) / 2 as cy from ge where error is null),
pts as ({_ring()} union all select k, epsg, 17, cx, cy from ext),
{lonlat_ctes("pts", "ll")},
ring as materialized (select k, i, {rounded("lon")} as lon, {rounded("lat")} as lat from ll),
box as (select k, min(lon) filter (i < 17) as xmin, min(lat) filter (i < 17) as ymin,
  max(lon) filter (i < 17) as xmax, max(lat) filter (i < 17) as ymax,
  max(lon) filter (i = 17) as longitude, max(lat) filter (i = 17) as latitude
  from ring group by k),
items as materialized (select ge.k, c, site, prefix, path_name, url, start_ts, end_ts,
  mid_ts as datetime,
  regexp_replace(split_part(url, '/', -1), '\\.nc$', '') as id, 'granules' as collection,
  xmin, ymin, xmax, ymax, longitude, latitude,
  {iso("mid_ts")} as mid_datetime, {iso("created_ts")} as created, {iso("updated_ts")} as updated,
  round_even(date_dt, 0) as date_dt, split_part(id_img1, '_', 1) as platform,
  id_img1 as scene_1_id, id_img2 as scene_2_id,
  case when coalesce(path_img1, 0) = 0 then 'N/A'
    else path_img1 || '/' || coalesce(row_img1, 0) end as scene_1_path_row,
  case when coalesce(path_img2, 0) = 0 then 'N/A'
    else path_img2 || '/' || coalesce(row_img2, 0) end as scene_2_path_row,
  coalesce(flight_direction_img1, 'N/A') as orbit_state,
  {iso("start_ts")} as start_datetime, {iso("end_ts")} as end_datetime,
  cast(round_even(roi_valid_percentage, 0) as int) as percent_valid_pixels,
  'EPSG:' || spatial_epsg as proj_code, '002' as version,
  case when starts_with(id_img1, 'S1') then 'sentinel1'
    when starts_with(id_img1, 'S2') then 'sentinel2' else 'landsatOLI' end as mission,
  {cell(center("latitude"), center("longitude"))} as cell,
  cast(year(mid_ts) as int) as year,
  case when starts_with(url, 's3://')
    then regexp_replace(url, '^s3://([^/]+)/(.*)$', 'https://\\1.s3.amazonaws.com/\\2')
    else url end as href,
  regexp_replace(url, '^https://([^/]+?)\\.s3\\.amazonaws\\.com/', 's3://\\1/') as s3_href
  from ge join box on ge.k = box.k where error is null)"""

# Edges of items: from each ring point to the next. A ring over the 180th meridian is there twice,
# unwrapped, once on either side of the map.
EDGE_CTES = """spans as (select k, max(lon) - min(lon) > 180 as crosses from ring where i < 17 group by k),
placed as materialized (select r.k, side, i, lat,
  case when not crosses then lon when side = 0 then (case when lon < 0 then lon + 360 else lon end)
    else (case when lon < 0 then lon + 360 else lon end) - 360 end as lon
  from ring r join spans on spans.k = r.k cross join (values (0), (1)) sides(side)
  where (crosses or side = 0) and i < 17),
edges as materialized (select a.k, a.lon as ax, a.lat as ay, b.lon as bx, b.lat as by_
  from placed a join placed b on a.k = b.k and a.side = b.side and b.i = a.i + 1)"""

ROI_CTES = f"""roi_edges as materialized ({roi_edges_sql()}),
roi_box as (select roi_id, min(x1) as rxmin, min(y1) as rymin, max(x1) as rxmax, max(y1) as rymax
  from roi_edges where ring = 0 group by roi_id)"""


def side(px, py, qx, qy, rx, ry) -> str:
    return f"(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"


def touch(a: tuple, b: tuple) -> str:
    """Whether two segments meet, ends and overlaps included."""
    ax, ay, bx, by = a
    cx, cy, dx, dy = b
    d1, d2 = side(cx, cy, dx, dy, ax, ay), side(cx, cy, dx, dy, bx, by)
    d3, d4 = side(ax, ay, bx, by, cx, cy), side(ax, ay, bx, by, dx, dy)

    def within(px, py, qx, qy, rx, ry):
        return (
            f"least({px}, {qx}) <= {rx} and {rx} <= greatest({px}, {qx})"
            f" and least({py}, {qy}) <= {ry} and {ry} <= greatest({py}, {qy})"
        )

    return f"""((sign({d1}) * sign({d2}) < 0 and sign({d3}) * sign({d4}) < 0)
 or ({d1} = 0 and {within(cx, cy, dx, dy, ax, ay)}) or ({d2} = 0 and {within(cx, cy, dx, dy, bx, by)})
 or ({d3} = 0 and {within(ax, ay, bx, by, cx, cy)}) or ({d4} = 0 and {within(ax, ay, bx, by, dx, dy)}))"""


def crossing(x: str, y: str, e: tuple) -> str:
    """1 when the ray from a point crosses an edge, else 0."""
    x1, y1, x2, y2 = e
    return (
        f"case when ({y1} > {y}) <> ({y2} > {y}) and {x} <"
        f" ({x2} - {x1}) * ({y} - {y1}) / ({y2} - {y1}) + {x1} then 1 else 0 end"
    )


# Pairs (k, roi_id) of items and query geometries that intersect.
PAIR_CTES = f"""cand as materialized (select k, roi_id from items join roi_box
  on xmin <= rxmax and xmax >= rxmin and ymin <= rymax and ymax >= rymin),
hit_edges as (select distinct c.k, c.roi_id from cand c join edges e on e.k = c.k
  join roi_edges r on r.roi_id = c.roi_id
  where {touch(("e.ax", "e.ay", "e.bx", "e.by_"), ("r.x1", "r.y1", "r.x2", "r.y2"))}),
hit_item as (select c.k, c.roi_id from cand c join placed p on p.k = c.k and p.i = 0
  join roi_edges r on r.roi_id = c.roi_id group by c.k, c.roi_id, p.lon, p.lat
  having sum({crossing("p.lon", "p.lat", ("r.x1", "r.y1", "r.x2", "r.y2"))}) % 2 = 1),
firsts as (select roi_id, ring, x1 as fx, y1 as fy from roi_edges where m = 0),
hit_roi as (select c.k, c.roi_id from cand c join firsts f on f.roi_id = c.roi_id
  join edges e on e.k = c.k group by c.k, c.roi_id, f.ring, f.fx, f.fy
  having sum({crossing("f.fx", "f.fy", ("e.ax", "e.ay", "e.bx", "e.by_"))}) % 2 = 1),
pairs as (select * from hit_edges union select * from hit_item union select * from hit_roi)"""


def items(select: str) -> str:
    return f"with {ITEM_CTES} {select}"


def granules(select: str) -> str:
    return f"with {GRANULE_CTES} {select}"


def item_pairs(select: str) -> str:
    return f"with {ITEM_CTES}, {EDGE_CTES}, {ROI_CTES}, {PAIR_CTES} {select}"
