"""Queries on names, links, paths, times and records of single granules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilewright.functions import cells, names, times
from tilewright.functions.numbers import round_exact, round_scaled
from tilewright.operators import sidecars as sc
from tilewright.plans import fixtures as fx
from tilewright.plans import reference_sql as rs
from tilewright.plans.registry import query
from tilewright.sources import tables

NAME_DATES = "regexp_extract_all(path_name, '[0-9]{8}')"
MID_DAY = (
    "cast(try_strptime(d[1], '%Y%m%d') as date) + cast(floor(date_diff('day',"
    " cast(try_strptime(d[1], '%Y%m%d') as date), cast(try_strptime(d[3], '%Y%m%d') as date))"
    " / cast(2 as double)) as int)"
)


def _good(spark, sf):
    return fx.derived(spark, sf).filter(F.col("error").isNull())


@query(
    rs.granules(
        f"""select prefix, path_name as path, strftime({MID_DAY}, '%Y') as year,
 case when len(d) < 3 then 'fewer than three dates in the name' end as error
 from (select prefix, path_name, {NAME_DATES} as d from g)"""
    )
)
def file_list(spark, sf):
    files = fx.granules(spark, sf).select("prefix", F.col("path_name").alias("path"))
    return tables.with_years(files)


LISTING_SQL = """select key from (select unnest([prefix || '/' || path_name,
 prefix || '/' || replace(path_name, '.nc', '.png'),
 prefix || '/' || path_name || '.premet']) as key from g)"""


def listing(spark, sf):
    """Three objects per granule: data, overview, sidecar."""
    key = F.concat("prefix", F.lit("/"), "path_name")
    keys = F.array(
        key, F.regexp_replace(key, r"\.nc$", ".png"), F.concat(key, F.lit(".premet"))
    )
    return fx.granules(spark, sf).select("site", F.explode(keys).alias("key"))


@query(
    rs.granules(
        f"""select 's3://{fx.STORE}/' || key as uri from ({LISTING_SQL})
 where regexp_matches(split_part(key, '/', -1), '^LC0[89].*P0.*$') and key like '%.nc'"""
    )
)
def listing_filter(spark, sf):
    return tables.filter_listing(listing(spark, sf), fx.STORE, "LC0[89]*P0*").select("uri")


def _lookup_sql(n: int, part: int) -> str:
    cases = " ".join(f"when '{t}' then '{s[part]}'" for t, s in rs.SENSORS.items())
    return f"case {rs.token(n)} {cases} end"


@query(
    rs.granules(
        f"""select k, {rs.token(1)} as token_1, {rs.token(2)} as token_2,
 {_lookup_sql(1, 0)} as platform_1, {_lookup_sql(1, 1)} as sensor_1,
 {_lookup_sql(2, 0)} as platform_2, {_lookup_sql(2, 1)} as sensor_2 from g"""
    )
)
def sensor_tokens(spark, sf):
    return sc.sensor_lookup(fx.granules(spark, sf).select("k", "url")).drop("url")


@query(
    rs.granules(
        f"""select k, strftime({MID_DAY}, '%Y-%m-%d') as mid_date,
 strftime({MID_DAY}, '%Y') as name_year, substr({rs.iso("mid_ts")}, 1, 4) as item_year
 from (select *, {NAME_DATES} as d from g)"""
    )
)
def mid_date(spark, sf):
    item_mid = times.iso_utc(times.parse_instant(F.col("date_center")))
    return fx.granules(spark, sf).select(
        "k",
        F.date_format(times.mid_date(F.col("path_name")), "yyyy-MM-dd").alias("mid_date"),
        times.year_of_name(F.col("path_name")).alias("name_year"),
        times.year_of_text(item_mid).alias("item_year"),
    )


@query(
    rs.granules(
        f"""select k, left(split_part(url, '/', -1), -3) as id,
 replace(url, 's3://{fx.STORE}/', 'https://{fx.STORE}.s3.amazonaws.com/') as https,
 replace(url, 'https://{fx.STORE}.s3.amazonaws.com/', 's3://{fx.STORE}/') as s3 from g"""
    )
)
def item_links(spark, sf):
    url = F.col("url")
    return fx.granules(spark, sf).select(
        "k",
        names.item_id(url).alias("id"),
        names.https_link(url).alias("https"),
        names.s3_link(url).alias("s3"),
    )


@query(
    rs.granules(
        f"""select k, a.key as key, left(replace(url, 's3://{fx.STORE}/',
 'https://{fx.STORE}.s3.amazonaws.com/'), -3) || a.ext as href, a.type as type, a.role as role,
 case when a.key = 'data' then replace(url, 'https://{fx.STORE}.s3.amazonaws.com/',
 's3://{fx.STORE}/') end as s3_href from g cross join (values
 {", ".join(f"('{k}', '{e}', '{t}', '{r}')" for k, e, t, r in rs.ASSETS)}) a(key, ext, type, role)"""
    )
)
def assets_long(spark, sf):
    assets = names.asset_map(F.col("url"))
    rows = fx.granules(spark, sf).select("k", F.explode(assets).alias("key", "asset"))
    return rows.select(
        "k",
        "key",
        F.col("asset.href").alias("href"),
        F.col("asset.type").alias("type"),
        F.col("asset.roles")[0].alias("role"),
        F.col("asset.alternate")["s3"]["href"].alias("s3_href"),
    )


@query(
    """with u as (select page_id, url, regexp_replace(url, '[?#].*$', '') as clean from pages),
 v as (select page_id, split_part(clean, '://', 1) as scheme, split_part(clean, '/', 3) as host,
   trim(array_to_string(list_slice(string_split(clean, '/'), 4, 999), '/'), '/') as path from u)
 select page_id, scheme || '://' || host || '/' || split_part(path, '/', 1) || '/' as base,
 case when strpos(path, '/') = 0 then '' else substr(path, strpos(path, '/') + 1) || '/' end
 as relative from v"""
)
def path_split(spark, sf):
    url = F.col("url")
    return fx.table(spark, sf, "pages").select(
        "page_id",
        names.catalog_base(url).alias("base"),
        names.catalog_relative(url).alias("relative"),
    )


@query(
    """select page_id, 'my store' as bucket,
 case when split_part(url, '://', 2) like '%/' then split_part(url, '://', 2)
 else split_part(url, '://', 2) || '/' end as prefix from pages"""
)
def storage_paths(spark, sf):
    """Page addresses, percent-encoded as object prefixes, decoded again."""
    rest = F.substring_index("url", "://", -1)
    coded = F.replace(F.url_encode(rest), F.lit("%2F"), F.lit("/"))
    path = F.concat(F.lit("s3://my%20store/"), coded)
    return fx.table(spark, sf, "pages").select(
        "page_id",
        names.storage_bucket(path).alias("bucket"),
        names.storage_prefix(path).alias("prefix"),
    )


@query(
    rs.granules(
        f"""select k, {rs.iso("start_ts")} as start_datetime, {rs.iso("end_ts")} as end_datetime,
 {rs.iso("mid_ts")} as mid_datetime, {rs.iso("created_ts")} as created,
 {rs.iso("updated_ts")} as updated from g"""
    )
)
def iso_times(spark, sf):
    def iso(name):
        return times.iso_utc(times.parse_instant(F.col(name)))

    updated = times.updated_or_created(F.col("date_updated"), F.col("date_created"))
    return fx.granules(spark, sf).select(
        "k",
        iso("acquisition_date_img1").alias("start_datetime"),
        iso("acquisition_date_img2").alias("end_datetime"),
        iso("date_center").alias("mid_datetime"),
        iso("date_created").alias("created"),
        times.iso_utc(updated).alias("updated"),
    )


@query(
    rs.granules(
        """select k, split_part(id_img1, '_', 1) as platform,
 coalesce(flight_direction_img1, 'N/A') as orbit_state,
 case when coalesce(path_img1, 0) <> 0 then path_img1 || '/' || row_img1 else 'N/A' end as path_row_1,
 case when coalesce(path_img2, 0) <> 0 then path_img2 || '/' || row_img2 else 'N/A' end as path_row_2,
 cast(round_even(date_dt, 0) as int) as days,
 cast(round_even(roi_valid_percentage, 0) as int) as valid,
 'EPSG:' || spatial_epsg as code from g"""
    )
)
def item_properties(spark, sf):
    return fx.granules(spark, sf).select(
        "k",
        names.first_token(F.col("id_img1")).alias("platform"),
        F.coalesce("flight_direction_img1", F.lit("N/A")).alias("orbit_state"),
        names.path_row(F.col("path_img1"), F.col("row_img1")).alias("path_row_1"),
        names.path_row(F.col("path_img2"), F.col("row_img2")).alias("path_row_2"),
        round_scaled(F.col("date_dt"), 0).cast("int").alias("days"),
        round_scaled(F.col("roi_valid_percentage"), 0).cast("int").alias("valid"),
        F.concat(F.lit("EPSG:"), F.col("spatial_epsg").cast("string")).alias("code"),
    )


@query(
    """select o_orderkey, round_even(o_totalprice * 100, 0) / 100 as scaled,
 cast(round_even(cast(o_totalprice / 7 as decimal(38, 20)), 2) as double) as exact from orders"""
)
def half_even_rounding(spark, sf):
    price = F.col("o_totalprice")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        round_scaled(price, 2).alias("scaled"),
        round_exact(price / 7, 2).alias("exact"),
    )


def _premet_sql() -> str:
    def lines(n):
        return (
            "'Container=AssociatedPlatformInstrumentSensor' || chr(10)"
            f" || 'AssociatedPlatformShortName=' || {_lookup_sql(n, 0)} || chr(10)"
            f" || 'AssociatedInstrumentShortName=' || {_lookup_sql(n, 1)} || chr(10)"
            f" || 'AssociatedSensorShortName=' || {_lookup_sql(n, 1)} || chr(10)"
        )

    clock = "'%H:%M:%S'"
    return rs.granules(
        f"""select k, 'FileName=' || left(split_part(url, '/', -1), -3) || chr(10)
 || 'VersionID_local=002' || chr(10)
 || 'Begin_date=' || strftime(start_ts, '%Y-%m-%d') || chr(10)
 || 'End_date=' || strftime(end_ts, '%Y-%m-%d') || chr(10)
 || 'Begin_time=' || strftime(start_ts, {clock}) || '.' || left(strftime(start_ts, '%f'), 3) || chr(10)
 || 'End_time=' || strftime(end_ts, {clock}) || '.' || left(strftime(end_ts, '%f'), 3) || chr(10)
 || {lines(1)} || {lines(2)} as premet from ge where error is null"""
    )


@query(_premet_sql())
def premet(spark, sf):
    return _good(spark, sf).select("k", sc.premet_text(F.col("version")).alias("premet"))


def _exact2(e: str) -> str:
    """Two decimals by the exact value of the double (its decimal expansion is long enough)."""
    s = "cast(100 as double)"
    grain = "cast(1048576 as double)"
    high = f"(floor({e} * {grain}) / {grain})"
    below = f"floor({e} * {s})"
    rest = f"(({high} * {s} - ({below} + 0.5::double)) + ({e} - {high}) * {s})"
    up = f"({rest} > 0 or ({rest} = 0 and (cast({below} as bigint) % 2 <> 0)))"
    return f"(({below} + case when {up} then 1 else 0 end) / {s})"


@query(
    rs.items(
        f"""select k, string_agg(cast({_exact2("lon")} as varchar) || chr(9)
 || cast({_exact2("lat")} as varchar), chr(10) order by o) || chr(10) as spatial from
 (select k, lon, lat, case i when 12 then 0 when 8 then 1 when 4 then 2 else 3 end as o
  from ring where i in (0, 4, 8, 12)) group by k"""
    )
)
def spatial_corners(spark, sf):
    return _good(spark, sf).select("k", sc.spatial_text(F.col("ring")).alias("spatial"))


FLAT_ITEM = (
    "id", "collection", "datetime", "mid_datetime", "created", "updated", "latitude", "longitude",
    "date_dt", "platform", "scene_1_id", "scene_2_id", "scene_1_path_row", "scene_2_path_row",
    "start_datetime", "end_datetime", "percent_valid_pixels", "version", "mission", "cell", "year",
)
FLAT_ITEM_SQL = (
    f"{', '.join(FLAT_ITEM)}, orbit_state, proj_code, xmin, ymin, xmax, ymax, href, s3_href"
)


def flat_items(df):
    box, data = F.col("bbox"), F.col("assets")["data"]
    return df.select(
        *FLAT_ITEM,
        F.col("`sat:orbit_state`").alias("orbit_state"),
        F.col("`proj:code`").alias("proj_code"),
        *[box[n].alias(n) for n in ("xmin", "ymin", "xmax", "ymax")],
        data["href"].alias("href"),
        data["alternate"]["s3"]["href"].alias("s3_href"),
    )


@query(rs.items(f"select {FLAT_ITEM_SQL} from items"))
def items(spark, sf):
    return flat_items(_good(spark, sf))


@query(
    rs.granules(
        "select k, url as href, cast(json_extract_string(props, '$.k') as bigint) as n"
        " from g left join events on event_id = k"
    )
)
def json_href(spark, sf):
    granules = fx.granules(spark, sf).select(
        "k", F.to_json(F.struct(F.struct(F.col("url").alias("href")).alias("data"))).alias("js")
    )
    events = fx.table(spark, sf, "events").select(F.col("event_id").alias("k"), "props")
    return granules.join(events, "k", "left").select(
        "k",
        names.json_href(F.col("js")).alias("href"),
        F.get_json_object("props", "$.k").cast("bigint").alias("n"),
    )


INTERVAL_SQL = (
    f"case k % 4 when 0 then {rs.iso('start_ts')} when 1 then {rs.iso('start_ts')} || '/'"
    f" when 2 then '../' || {rs.iso('end_ts')} else {rs.iso('least(start_ts, end_ts)')} || '/' ||"
    f" {rs.iso('greatest(start_ts, end_ts)')} end"
)


def _intervals(spark, sf):
    start = times.parse_instant(F.col("acquisition_date_img1"))
    end = times.parse_instant(F.col("acquisition_date_img2"))
    dated = fx.granules(spark, sf).select("k", start.alias("s"), end.alias("e"))
    low, high = F.least("s", "e"), F.greatest("s", "e")
    text = (
        F.when(F.col("k") % 4 == 0, times.iso_utc(F.col("s")))
        .when(F.col("k") % 4 == 1, F.concat(times.iso_utc(F.col("s")), F.lit("/")))
        .when(F.col("k") % 4 == 2, F.concat(F.lit("../"), times.iso_utc(F.col("e"))))
        .otherwise(F.concat(times.iso_utc(low), F.lit("/"), times.iso_utc(high)))
    )
    return dated.select("k", text.alias("interval")).filter(F.col("interval").isNotNull())


@query(
    rs.granules(
        """select k, cast(unnest(generate_series(low, high)) as varchar) as year from
 (select k, year(case k % 4 when 2 then end_ts when 3 then least(start_ts, end_ts)
    else start_ts end) as low,
   year(case k % 4 when 2 then end_ts when 3 then greatest(start_ts, end_ts) else start_ts end)
     as high from g) where low is not null and high is not null"""
    )
)
def years_expand(spark, sf):
    return _intervals(spark, sf).select("k", F.explode(times.years_in(F.col("interval"))).alias("year"))


@query(
    rs.granules(
        """select k, strftime(case k % 4 when 2 then null when 3 then least(start_ts, end_ts)
 else start_ts end, '%Y-%m-%d %H:%M:%S.%f') as low,
 strftime(case k % 4 when 0 then start_ts when 1 then null when 2 then end_ts
 else greatest(start_ts, end_ts) end, '%Y-%m-%d %H:%M:%S.%f') as high
 from g where start_ts is not null"""
    )
)
def interval_ends(spark, sf):
    def text(ts):
        return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")

    return _intervals(spark, sf).select(
        "k",
        text(times.interval_start(F.col("interval"))).alias("low"),
        text(times.interval_end(F.col("interval"))).alias("high"),
    )


ANY_POINT = (
    "select o_orderkey as k, ((o_orderkey * 7919) % 36001) / cast(100 as double) - 180 as lon,"
    " ((o_orderkey * 104729 + o_custkey) % 18001) / cast(100 as double) - 90 as lat from orders"
)


@query(
    f"""select k, {rs.cell(rs.center("lat"), rs.center("lon"), fold=False)} as raw_cell,
 {rs.cell(rs.center("lat"), rs.center("lon"))} as cell from ({ANY_POINT})"""
)
def cell_names(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    hundred = F.lit(100.0).cast("double")
    points = fx.table(spark, sf, "orders").select(
        k.alias("k"),
        ((k * 7919) % 36001 / hundred - 180).alias("lon"),
        ((k * 104729 + c) % 18001 / hundred - 90).alias("lat"),
    )
    lon, lat = F.col("lon"), F.col("lat")
    return points.select(
        "k",
        cells.home_cell(lon, lat, raw=True).alias("raw_cell"),
        cells.home_cell(lon, lat).alias("cell"),
    )


@query(
    """select o_orderkey as k, 586000000000000000 + o_orderkey * 1048576 as directory from orders"""
)
def hex_directories(spark, sf):
    """Hexadecimal cell ids of whole numbers, read back as directory numbers."""
    number = F.lit(586000000000000000) + F.col("o_orderkey") * 1048576
    text = F.lower(F.hex(number))
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), cells.hex_directory(text).alias("directory")
    )


@query(
    rs.granules(
        """select k, strftime(mid_ts, '%Y') || '-chunk' || lpad(cast(k % 12000 as varchar),
 cast(greatest(4, length(cast(k % 12000 as varchar))) as int), '0') as id, strftime(mid_ts, '%Y') as year,
 cast(k % 12000 as int) as chunk from g"""
    )
)
def chunk_names(spark, sf):
    year = F.date_format(times.parse_instant(F.col("date_center")), "yyyy")
    ids = fx.granules(spark, sf).select("k", names.chunk_id(year, F.col("k") % 12000).alias("id"))
    file = F.concat(F.lit("chunks/"), F.col("id"), F.lit(".ndjson"))
    return ids.select(
        "k", "id", names.chunk_year(file).alias("year"), names.chunk_number(file).alias("chunk")
    )


@query(
    rs.items(
        f"""select k, 's3://{fx.STORE}/' || prefix || '/' || path_name as uri,
 regexp_replace(s3_href, '/[^/]*$', '/') || id || '.nc.premet' as sidecar from items"""
    )
)
def object_addresses(spark, sf):
    href = F.col("assets")["data"]["alternate"]["s3"]["href"]
    slashed = F.concat("prefix", F.lit("/"))
    return _good(spark, sf).select(
        "k",
        names.object_uri(fx.STORE, slashed, F.col("path_name")).alias("uri"),
        names.sidecar_path(href, F.col("id"), ".nc.premet").alias("sidecar"),
    )


@query(
    rs.granules(
        f"""select key, regexp_extract(key, '^velocity_image_pair/[^/]+/') as dir,
 md5(key || chr(10)) as file_id from ({LISTING_SQL})"""
    )
)
def key_directories(spark, sf):
    key = F.col("key")
    return listing(spark, sf).select(
        "key",
        names.first_directory(key, "velocity_image_pair/").alias("dir"),
        names.line_md5(key).alias("file_id"),
    )
