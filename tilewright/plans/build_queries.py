"""Queries on numbered batches, chunks, manifests and written items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilewright.operators import audit, derive, numbering, quality, state, upsert
from tilewright.operators import sidecars as sc
from tilewright.plans import fixtures as fx
from tilewright.plans import reference_sql as rs
from tilewright.plans.registry import query
from tilewright.plans.scalar_queries import FLAT_ITEM
from tilewright.sources import catalog, tables
from tilewright.staging import new_path, stage

# Batch of a region build, and page of an object listing.
BATCH, PAGE = 200, 5000

# One listed object per line item; every 41st part fails and reaches no chunk.
LISTING = {
    "region": "l_returnflag",
    "key": "lpad(cast(l_orderkey as string), 9, '0') || '-' || cast(l_linenumber as string) || '-'"
    " || lpad(cast(l_partkey as string), 9, '0') || '-' || lpad(cast(l_suppkey as string), 9, '0')",
    "year": "cast(year(l_shipdate) as string)",
    "failed": "l_partkey % 41 = 0",
    "line": "cast(l_orderkey as string) || '|' || cast(l_linenumber as string) || '|' ||"
    " cast(l_partkey as string) || '|' || l_linestatus",
}
_COLUMNS = ", ".join(f"{e} as {n}" for n, e in LISTING.items())


def _ctes(size: int) -> tuple[str, str]:
    batch = f"""lst as (select {_COLUMNS} from lineitem),
b as (select *, cast((row_number() over (partition by region order by key) - 1) // {size} as bigint)
  as batch from lst)"""
    chunk = f"""{batch},
ch as (select *, cast(dense_rank() over (partition by region, year order by batch) - 1 as int)
  as chunk from b where not failed)"""
    return batch, chunk


BATCH_CTES, CHUNK_CTES = _ctes(BATCH)
PAGE_CTES = _ctes(PAGE)[1]
STATS_SQL = """select region, year, chunk, cast(sum(strlen(line) + 1) as bigint) as size_bytes,
 md5(string_agg(line, chr(10) order by key) || chr(10)) as md5_hash, count(*) as item_count
 from ch group by region, year, chunk"""
CHUNK_ID = "year || '-chunk' || lpad(cast(chunk as varchar), 4, '0')"
STATE_SQL = """select l_returnflag as region, count(*) % 37 + 10 as last_batch,
 cast(1000 as bigint) as total_files_processed from lineitem where l_returnflag <> 'N'
 group by l_returnflag"""


def listing(spark, sf):
    return fx.table(spark, sf, "lineitem").selectExpr(*[f"{e} as {n}" for n, e in LISTING.items()])


def batched(spark, sf, size=BATCH):
    return numbering.listing_batches(listing(spark, sf), size)


def chunked(spark, sf, size=BATCH):
    return numbering.number_chunks(batched(spark, sf, size).filter(~F.col("failed")))


def _states(spark, sf):
    counted = listing(spark, sf).filter("region <> 'N'").groupBy("region").count()
    return counted.select(
        "region",
        (F.col("count") % 37 + 10).alias("last_batch"),
        F.lit(1000).cast("bigint").alias("total_files_processed"),
    )


def _lines(chunks):
    return chunks.select("region", "year", "chunk", F.col("key").alias("line_no"), "line")


@query(f"with {BATCH_CTES} select region, key, batch from b")
def listing_batches(spark, sf):
    return batched(spark, sf).select("region", "key", "batch")


@query(
    f"""with {BATCH_CTES}, st as ({STATE_SQL}) select b.region, key, batch from b left join st
 on st.region = b.region where batch > coalesce(last_batch, -1)"""
)
def pending_batches(spark, sf):
    left = numbering.pending(batched(spark, sf), _states(spark, sf))
    return left.select("region", "key", "batch")


@query(
    f"""with {BATCH_CTES}, grown as (select region, key, failed from b where key not like '%7'),
 counts as (select region, count(*) as n from b where key like '%7' group by region)
 select g.region, key, cast((row_number() over (partition by g.region order by key) - 1) // {BATCH}
  + (coalesce(n, 0) + {BATCH} - 1) // {BATCH} as bigint) as batch
 from grown g left join counts c on c.region = g.region"""
)
def resume_grown_listing(spark, sf):
    """A first run over keys from all over the listing, its last batches not full; then the rest."""
    first = numbering.listing_batches(listing(spark, sf).filter("key like '%7'"), BATCH)
    first = stage(first, "first-run")
    done = state.advance(state.reset_state(spark), first.select("region", "batch"))
    left = numbering.remaining_batches(
        listing(spark, sf), first.select("region", "key"), stage(done, "state"), BATCH
    )
    return left.select("region", "key", "batch")


@query(f"with {CHUNK_CTES} select region, key, year, batch, chunk from ch")
def chunk_numbers(spark, sf):
    return chunked(spark, sf).select("region", "key", "year", "batch", "chunk")


@query(f"with {CHUNK_CTES} select region, key, year, batch, chunk from ch")
def chunk_numbers_resumed(spark, sf):
    """Two runs, the second going on from the first one's counters."""
    good = stage(batched(spark, sf).filter(~F.col("failed")), "good")
    first = numbering.number_chunks(good.filter("batch <= 20"))
    first = stage(first, "first")
    second = numbering.number_chunks(good.filter("batch > 20"), state.counters(first))
    return first.unionByName(second).select("region", "key", "year", "batch", "chunk")


@query(f"with {CHUNK_CTES} select *, {CHUNK_ID} as id from ({STATS_SQL})")
def chunk_manifest(spark, sf):
    return state.manifest(state.chunk_stats(_lines(chunked(spark, sf))))


@query(
    f"""with {CHUNK_CTES} select region, year, max(chunk) as max_chunk, max(chunk) + 1 as counter
 from ch group by region, year"""
)
def chunk_counters(spark, sf):
    chunks = stage(chunked(spark, sf).select("region", "year", "chunk"), "chunks")
    return state.highest_chunks(chunks).join(state.counters(chunks), ["region", "year"])



@query(
    f"""with {CHUNK_CTES}, s as (select region, year, max(chunk) as max_chunk from ch
 group by region, year), r as (select region, year, max(chunk) as recorded_max from ch
 where not (region = 'R' and year = '1998') and (cast(year as int) % 2 = 0 or chunk < 5)
 group by region, year)
 select s.region, s.year, max_chunk, recorded_max,
 recorded_max is null or max_chunk > recorded_max as out_of_sync
 from s left join r on r.region = s.region and r.year = s.year"""
)
def chunks_out_of_sync(spark, sf):
    stored = stage(chunked(spark, sf).select("region", "year", "chunk").distinct(), "stored")
    recorded = stored.filter(
        "not (region = 'R' and year = '1998') and (cast(year as int) % 2 = 0 or chunk < 5)"
    )
    return state.out_of_sync(stored, recorded)


@query(
    f"""with {CHUNK_CTES}, s as ({STATS_SQL}),
 f as (select region, year, unnest(generate_series(0, max(chunk))) as chunk from ch
  group by region, year)
 select f.region, f.year, cast(f.chunk as int) as chunk,
 f.year || '-chunk' || lpad(cast(f.chunk as varchar), 4, '0') as id,
 coalesce(size_bytes, 0) as size_bytes, coalesce(md5_hash, '') as md5_hash,
 coalesce(item_count, 0) as item_count
 from f left join s on s.region = f.region and s.year = f.year and s.chunk = f.chunk
 and s.chunk % 3 <> 1"""
)
def manifest_rebuild(spark, sf):
    """Statistics are at hand for some of the chunks only."""
    lines = stage(_lines(chunked(spark, sf)), "lines")
    stats = state.chunk_stats(lines.filter("chunk % 3 <> 1"))
    return state.rebuild_manifest(lines.select("region", "year", "chunk").distinct(), stats)


@query(f"with {CHUNK_CTES} select region, year, chunk, line from ch where chunk % 4 = 0")
def missing_chunk_lines(spark, sf):
    remote = stage(_lines(chunked(spark, sf)), "remote")
    local = remote.filter("chunk % 4 <> 0")
    return state.missing_chunks(remote, local).select("region", "year", "chunk", "line")


@query(f"with {CHUNK_CTES} select region, year, chunk, line from ch")
def chunk_table(spark, sf):
    """Chunks written as a table, then read back."""
    path = new_path(spark, "chunks")
    tables.write_chunks(_lines(chunked(spark, sf)), path)
    schema = "chunk int, line_no string, line string, region string, year string"
    return spark.read.schema(schema).parquet(path).select("region", "year", "chunk", "line")


@query(f"with {PAGE_CTES} {STATS_SQL}")
def chunk_files(spark, sf):
    """Sizes, checksums and counts of chunk files as they lie on storage."""
    path = new_path(spark, "chunk-files")
    tables.write_chunk_files(_lines(chunked(spark, sf, PAGE)), path)
    return state.chunk_stats(tables.read_chunk_lines(spark, path))


@query(f"with {CHUNK_CTES} select region, year, line from ch")
def consolidated_years(spark, sf):
    path = new_path(spark, "years")
    tables.consolidate(stage(_lines(chunked(spark, sf)), "lines"), path)
    schema = "value string, region string, year string"
    read = spark.read.schema(schema).text(path)
    return read.select("region", "year", F.col("value").alias("line"))


@query(
    f"""with {BATCH_CTES}, st as ({STATE_SQL}), d as (select region, max(batch) as bb, count(*) as n
 from b group by region)
 select d.region, bb as last_batch, coalesce(total_files_processed, 0) + n as total_files_processed
 from d left join st on st.region = d.region"""
)
def region_totals(spark, sf):
    """State after a run; failed files count as processed."""
    return state.advance(_states(spark, sf), batched(spark, sf).select("region", "batch"))


@query(
    f"""with st as ({STATE_SQL}) select region, case when region = 'A' then 7 else last_batch end
 as last_batch, total_files_processed from st"""
)
def resume_points(spark, sf):
    states = _states(spark, sf)
    progress = states.filter("region = 'A'").select("region", F.lit(7).alias("counter"))
    return state.resume_from(states, progress)


@query(
    f"""with st as ({STATE_SQL}) select region, cast(-1 as bigint) as last_batch,
 cast(0 as bigint) as total_files_processed from st"""
)
def reset_regions(spark, sf):
    return state.reset_state(spark, _states(spark, sf))


@query(
    rs.items(
        "select prefix, strftime(datetime, '%Y') as year, count(*) as n from items group by all"
    )
)
def prefix_year_counts(spark, sf):
    good = derive.good_items(fx.derived(spark, sf))
    return audit.prefix_year_counts(
        good.select("prefix", F.substring("mid_datetime", 1, 4).alias("year"))
    )


@query(
    rs.granules(
        """select count(*) as expected, count(*) filter (where error is null) as processed,
 count(*) <> count(*) filter (where error is null) as mismatch from ge"""
    )
)
def build_totals(spark, sf):
    return audit.totals_check(fx.derived(spark, sf))


@query(
    rs.granules(
        """select count(*) as expected, count(*) filter (where error is null) as processed,
 count(*) <> count(*) filter (where error is null) as mismatch from ge"""
    )
)
def observed_totals(spark, sf):
    """The same totals, seen while the rows are written."""
    counted, totals = audit.observed(fx.derived(spark, sf))
    stage(counted, "derived")
    return totals()


_LINE_COLUMNS = [c for c in FLAT_ITEM if c not in ("mission", "cell", "year")]
_LINE_SQL = ", ".join(_LINE_COLUMNS)


@query(
    rs.items(
        f"""select {_LINE_SQL}, prefix, strftime(datetime, '%Y') as year, xmin, ymax, href, s3_href,
 18 as ring_and_links from items"""
    )
)
def item_lines(spark, sf):
    """Item NDJSON by prefix and year, parsed back into catalog rows."""
    path = new_path(spark, "items")
    good = derive.good_items(fx.derived(spark, sf)).withColumn(
        "year", F.substring("mid_datetime", 1, 4)
    )
    tables.write_items(good, path, "prefix", "year")
    read = tables.read_item_lines(spark, path)
    data = F.col("assets")["data"]
    return read.select(
        *_LINE_COLUMNS,
        "prefix",
        "year",
        "bbox.xmin",
        "bbox.ymax",
        data["href"].alias("href"),
        data["alternate"]["s3"]["href"].alias("s3_href"),
        (F.size("ring") + F.size(F.col("assets")["thumbnail"]["roles"])).alias("ring_and_links"),
    )


@query(
    rs.items(
        "select mission, cast(k // 5000 as bigint) as row_group, count(*) as n from items group by all"
    )
)
def published_row_groups(spark, sf):
    """Items of row groups published under mission and row group directories."""
    path = new_path(spark, "published")
    group = F.floor(F.col("k") / 5000).cast("bigint").alias("row_group")
    good = derive.good_items(fx.derived(spark, sf)).select("*", group)
    tables.write_items(good, path, "mission", "row_group")
    schema = "value string, mission string, row_group bigint"
    return spark.read.schema(schema).text(path).groupBy("mission", "row_group").agg(
        F.count("*").alias("n")
    )


@query(
    rs.items(
        f"""select id, kind, regexp_replace(s3_href, '/[^/]*$', '/') || id || suffix as target_path
 from items cross join (values {", ".join(f"('{k}', '{s}')" for k, s in rs.SUFFIXES.items())})
 v(kind, suffix)"""
    )
)
def sidecar_targets(spark, sf):
    path = new_path(spark, "sidecars")
    tables.write_sidecars(sc.sidecars(derive.good_items(fx.derived(spark, sf))), path)
    return spark.read.parquet(path).select("id", "kind", "target_path")


@query(
    rs.items(
        """select id, case when percent_valid_pixels = 9 then 'premet,spatial'
 when percent_valid_pixels % 10 = 3 then 'premet' else 'spatial' end as missing from items
 where percent_valid_pixels % 10 = 3 or percent_valid_pixels = 9"""
    )
)
def sidecar_missing(spark, sf):
    good = derive.good_items(fx.derived(spark, sf))
    pvp = F.col("percent_valid_pixels")
    kinds = F.explode(F.array(*[F.lit(k) for k in sc.SUFFIXES])).alias("kind")
    written = good.select("id", pvp, kinds).filter(
        ~((F.col("kind") == "premet") & ((pvp % 10 == 3) | (pvp == 9)))
        & ~((F.col("kind") == "spatial") & (pvp == 9))
    )
    return sc.missing_sidecars(good, written)


@query(
    rs.items(
        """select id, unnest(list_filter([
 case when percent_valid_pixels = 13 then 'assets missing' end,
 case when date_dt % 50 = 3 then 'ring not closed' end,
 case when start_datetime > end_datetime then 'dates out of order' end,
 case when percent_valid_pixels = 13 then 'no data asset' end], lambda r: r is not null)) as rule
 from items"""
    )
)
def item_faults(spark, sf):
    """Validity findings, with a few items spoilt on purpose."""
    spoilt = fx.items(spark, sf).withColumns(
        {
            "assets": F.when(F.col("percent_valid_pixels") != 13, F.col("assets")),
            "ring": F.when(F.col("date_dt") % 50 == 3, F.slice("ring", 1, 16)).otherwise(
                F.col("ring")
            ),
        }
    )
    return quality.item_faults(spoilt)


@query(
    rs.items(
        """select id, unnest(list_filter([
 case when datetime < timestamp '1996-01-01' or datetime > timestamp '2000-12-31 23:59:59'
  then 'outside interval' end,
 case when xmin < -180 or ymin < -90 or xmax > 180 or ymax > 80 then 'outside box' end,
 case when proj_code not in ('EPSG:3413', 'EPSG:4326', 'EPSG:3031') then 'projection not declared'
 end], lambda r: r is not null)) as rule from items"""
    )
)
def undeclared_items(spark, sf):
    interval = ("1996-01-01T00:00:00Z", "2000-12-31T23:59:59Z")
    return quality.undeclared(fx.items(spark, sf), interval, (-180.0, -90.0, 180.0, 80.0))


@query(
    rs.items(
        """select rule, count(*) as n from (select unnest(list_filter([
 case when date_dt < 7 then 'date_dt below 7' end,
 case when date_dt > 180 then 'date_dt above 180' end], lambda r: r is not null)) as rule
 from items) group by rule"""
    )
)
def violations_per_rule(spark, sf):
    return quality.violations_per_rule(quality.range_violations(fx.items(spark, sf)))


@query(
    rs.items(
        """select collection, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax,
 max(ymax) as ymax, min(start_datetime) as start_datetime, max(end_datetime) as end_datetime,
 array_to_string(list_sort(list(distinct proj_code)), ',') as proj_codes, count(*) as n
 from items group by collection"""
    )
)
def collection_extent(spark, sf):
    return audit.collection_extent(fx.items(spark, sf))


@query(
    rs.items(
        """select id, mission, cell, case when percent_valid_pixels % 7 = 0 then 'second'
 else platform end as platform from items"""
    )
)
def catalog_upsert(spark, sf):
    """A snapshot of the catalog with every seventh item replaced twice; the last one counts."""
    items = fx.items(spark, sf).filter("percent_valid_pixels % 7 = 0")
    updates = [
        items.withColumns({"platform": F.lit(text), "turn": F.lit(n)})
        for n, text in enumerate(("first", "second"))
    ]
    target = new_path(spark, "snapshot")
    upsert.upsert_catalog(
        spark,
        fx.catalog_path(spark, sf),
        updates[0].unionByName(updates[1]),
        ["turn"],
        target,
        partitions=("mission", "cell"),
    )
    read = catalog.read_catalog(spark, target, ("mission", "cell"))
    return read.select("id", "mission", "cell", "platform")


_BY_YEAR = ("mission", "year")


@query(
    rs.items(
        """select id, mission, case when percent_valid_pixels % 7 = 0 and date_dt % 2 = 0 then year + 50
 else year end as year, case when percent_valid_pixels % 7 = 0 then 'second' else platform end as platform
 from items"""
    )
)
def partition_upsert(spark, sf):
    """A live catalog with every seventh item replaced twice in place, half of them in another year."""
    path, items = new_path(spark, "live"), fx.items(spark, sf).drop("cell")
    catalog.write_catalog(items, path, _BY_YEAR)
    moved = items.filter("percent_valid_pixels % 7 = 0").withColumn(
        "year", F.col("year") + F.when(F.col("date_dt") % 2 == 0, 50).otherwise(0)
    )
    twice = [
        moved.withColumns({"platform": F.lit(text), "turn": F.lit(n)}) for n, text in enumerate(("first", "second"))
    ]
    upsert.upsert_partitions(spark, path, twice[0].unionByName(twice[1]), ["turn"], _BY_YEAR)
    return catalog.read_catalog(spark, path, _BY_YEAR).select("id", "mission", "year", "platform")


@query(
    rs.items(
        """select mission, year, count(*) as n, max((id in (select id from items where year % 2 = 0
 and mission <> 'sentinel1' and percent_valid_pixels = 50))::int) as version from items group by mission, year"""
    )
)
def partition_versions(spark, sf):
    """Which entry of the log wrote each partition: the second one only those it had an update for."""
    path, items = new_path(spark, "live"), fx.items(spark, sf).drop("cell")
    catalog.write_catalog(items, path, _BY_YEAR)
    some = items.filter("percent_valid_pixels = 50 and year % 2 = 0 and mission <> 'sentinel1'")
    upsert.upsert_partitions(spark, path, some, ["id"], _BY_YEAR)
    return catalog.snapshot_files(spark, path, partitions=_BY_YEAR).select("mission", "year", "n", "version")
