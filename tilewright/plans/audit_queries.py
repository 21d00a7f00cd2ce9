"""Queries on upserts, progress logs, directory counts and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilewright import jobs
from tilewright.operators import audit, upsert
from tilewright.plans import fixtures as fx
from tilewright.plans.registry import query
from tilewright.sources import tables
from tilewright.staging import new_path
from tilewright.streaming import ingest as stream
from tilewright.streaming import levels

KEY = ["l_orderkey", "l_linenumber"]
ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
FEED = [*KEY, *ORDER, "l_returnflag", "l_quantity"]
_RANKED = f"""select *, row_number() over (partition by {", ".join(KEY)}
 order by {", ".join(o + " desc" for o in ORDER)}) as rn from lineitem"""
_OUT = ", ".join(
    "strftime(l_shipdate, '%Y-%m-%d') as l_shipdate" if c == "l_shipdate" else c for c in FEED
)


def _dated(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(f"select {_OUT} from ({_RANKED}) where rn = 1")
def latest_rows(spark, sf):
    """The last version of every key of a feed with repeated keys."""
    feed = fx.table(spark, sf, "lineitem").select(*FEED)
    return _dated(upsert.latest(feed, KEY, ORDER))


@query(
    f"""with base as (select * from ({_RANKED.replace("from lineitem", "from lineitem where l_returnflag = 'A'")}) where rn = 1),
 upd as (select * from ({_RANKED.replace("from lineitem", "from lineitem where l_returnflag <> 'A'")}) where rn = 1)
 select {_OUT} from (select * from upd union all select * from base b where not exists
 (select 1 from upd u where u.l_orderkey = b.l_orderkey and u.l_linenumber = b.l_linenumber))"""
)
def upsert_latest(spark, sf):
    """A base snapshot with a feed of updates merged in."""
    feed = fx.table(spark, sf, "lineitem").select(*FEED)
    base = upsert.latest(feed.filter("l_returnflag = 'A'"), KEY, ORDER)
    return _dated(upsert.upsert(base, feed.filter("l_returnflag <> 'A'"), KEY, ORDER))


@query(
    """select user_id as file, event_id as line_no, cast((row_number() over (partition by user_id
 order by event_id) - 1) // 20 as bigint) as upload_chunk from events"""
)
def upload_chunks(spark, sf):
    lines = fx.table(spark, sf, "events").select(
        F.col("user_id").alias("file"), F.col("event_id").alias("line_no")
    )
    return upsert.upload_chunks(lines, 20)


PROGRESS = {
    "status": "case event_type when 'purchase' then 'COMPLETED' when 'signup' then"
    " 'COMPLETED_WITH_ERRORS' when 'error' then 'FAILED' when 'view' then 'CHUNK_FAILED'"
    " else 'INPROGRESS' end",
    "file": "'f' || lpad(cast((event_id * 7919) % 6007 as string), 5, '0')",
    "start_ts": "'2024-01-01 ' || lpad(cast(event_id % 24 as string), 2, '0') || ':00:00'",
    "end_ts": "'2024-02-01 ' || lpad(cast(event_id as string), 9, '0')",
    "items": "event_id % 100",
    "secs": "event_id % 61",
    "note": "case when event_type = 'signup' then cast(event_id % 5 as string) || ' failed chunks'"
    " when event_type in ('error', 'view') then 'no answer | ' || cast(event_id as string) end",
}
_PROGRESS_SQL = "select " + ", ".join(f"{e} as {n}" for n, e in PROGRESS.items()) + " from events"


def progress(spark, sf):
    return fx.table(spark, sf, "events").selectExpr(*[f"{e} as {n}" for n, e in PROGRESS.items()])


def _listed(spark, sf):
    return fx.table(spark, sf, "events").selectExpr(f"{PROGRESS['file']} as file").distinct()


_DONE = "status like 'COMPLETED%'"


@query(
    f"""with p as ({_PROGRESS_SQL}) select status, file, start_ts,
 case when {_DONE} then end_ts end as end_ts, case when {_DONE} then items end as items,
 case when {_DONE} then secs end as secs,
 case when {_DONE} then note when status <> 'INPROGRESS' then note end as note from p"""
)
def progress_log(spark, sf):
    """Progress records appended to a log and read back."""
    path = new_path(spark, "progress")
    tables.append_progress(progress(spark, sf), path)
    return tables.read_progress(spark, path)


@query(
    f"""with p as ({_PROGRESS_SQL}) select distinct file from p where file not in
 (select file from p where status = 'COMPLETED')"""
)
def pending_files(spark, sf):
    return audit.pending_files(_listed(spark, sf), progress(spark, sf))


@query(
    f"""with p as ({_PROGRESS_SQL}) select status, count(*) as n,
 cast(sum(case when status like 'COMPLETED%' then items else 0 end) as bigint) as items,
 cast(sum(secs) as bigint) as secs from p group by status"""
)
def progress_stats(spark, sf):
    return audit.progress_stats(progress(spark, sf))


_TOTALS = """count(*) filter (where status = 'COMPLETED') as completed,
 count(*) filter (where status = 'COMPLETED_WITH_ERRORS') as completed_with_errors,
 count(*) filter (where status = 'FAILED') as failed,
 cast(sum(case when status like 'COMPLETED%' then items else 0 end) as bigint) as total_items"""


@query(f"with p as ({_PROGRESS_SQL}) select {_TOTALS} from p")
def progress_totals(spark, sf):
    return audit.progress_totals(progress(spark, sf))


@query(
    f"""with p as ({_PROGRESS_SQL}), l as (select *, row_number() over (partition by file
 order by end_ts desc) as rn from p) select {_TOTALS} from l where rn = 1"""
)
def progress_totals_latest(spark, sf):
    return audit.progress_totals(progress(spark, sf), latest_only=True)


@query(
    f"""with p as ({_PROGRESS_SQL}) select file, count(*) as chunks_processed,
 count(*) filter (where status = 'CHUNK_FAILED') as chunks_failed,
 case when count(*) filter (where status = 'CHUNK_FAILED') > 0 then 'COMPLETED_WITH_ERRORS'
 else 'COMPLETED' end as status from p group by file"""
)
def chunk_outcomes(spark, sf):
    chunks = progress(spark, sf).select("file", (F.col("status") == "CHUNK_FAILED").alias("failed"))
    return audit.chunk_outcomes(chunks)


_KEY = "'store/' || source || '/' || cast(doc_id as string) || '.' || lang"


def documents(spark, sf):
    return fx.table(spark, sf, "documents").selectExpr(f"{_KEY} as key", "source as dir")


@query(
    """select source as dir, count(*) filter (where lang = 'es') as n from documents
 group by source order by n, dir"""
)
def dir_counts(spark, sf):
    return audit.by_count(audit.directory_counts(documents(spark, sf), ".es"))


@query(
    """select 'store/' || source || '/' as dir, count(*) filter (where lang = 'en') as n
 from documents group by source"""
)
def prefix_dir_counts(spark, sf):
    keys = documents(spark, sf).select("key")
    return audit.directory_counts(keys, ".en", prefix="store/")


# The cache knows a third of the sources with old counts, and two that are gone.
_CACHE_SQL = """select source as dir, cast(count(*) + 1000 as bigint) as count,
 cast('2024-01-0' || cast(1 + length(source) % 9 as string) as date) as as_of from documents
 where length(source) = 4 group by source
 union all select 'gone-' || source, cast(1 as bigint), cast('2023-12-31' as date) from documents
 where source in ('src1', 'src2') group by source"""


def _cache(spark, sf):
    counts = fx.table(spark, sf, "documents").groupBy("source").count()
    day = F.concat(F.lit("2024-01-0"), (1 + F.length("source") % 9).cast("string")).cast("date")
    known = counts.filter(F.length("source") == 4).select(
        F.col("source").alias("dir"), (F.col("count") + 1000).alias("count"), day.alias("as_of")
    )
    gone = counts.filter(F.col("source").isin("src1", "src2")).select(
        F.concat(F.lit("gone-"), "source").alias("dir"), F.lit(1).cast("bigint").alias("count"),
        F.lit("2023-12-31").cast("date").alias("as_of"),
    )
    return known.unionByName(gone)


_FRESH_SQL = """select source as dir, count(*) filter (where lang = 'en') as n from documents
 where source not in (select dir from cache) group by source"""


@query(
    f"""with cache as ({_CACHE_SQL}), fresh as ({_FRESH_SQL})
 select dir, count as n, strftime(as_of, '%Y-%m-%d') as as_of from cache
 union all select dir, n, '2024-03-01' from fresh"""
)
def dir_counts_merge(spark, sf):
    """Only directories without a cached count are counted; all are reported."""
    today = F.lit("2024-03-01").cast("date")
    merged = audit.count_incrementally(documents(spark, sf), _cache(spark, sf), ".en", today)
    return merged.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))


@query(
    f"""with cache as ({_CACHE_SQL}), fresh as ({_FRESH_SQL})
 select dir, count as n, strftime(as_of, '%Y-%m-%d') as as_of from cache where dir not like 'gone%'
 union all select dir, n, '2024-03-01' from fresh"""
)
def dir_counts_listed(spark, sf):
    """The same, without directories that are no longer listed."""
    today = F.lit("2024-03-01").cast("date")
    merged = audit.count_incrementally(
        documents(spark, sf), _cache(spark, sf), ".en", today, drop_stale=True
    )
    return merged.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))


@query(
    """select user_id, event_id, event_type, cast(round(value * 100) as bigint) as cents from
 (select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
 where rn = 1"""
)
def stream_upsert(spark, sf):
    """Event files taken in as a stream in two calls; the last row per user wins."""
    source, table, checkpoint = (new_path(spark, n) for n in ("arriving", "deltas", "offsets"))
    events = fx.table(spark, sf, "events").select(
        "user_id",
        "event_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    for late in (False, True):
        part = events.filter((F.col("event_id") % 3 == 0) == F.lit(late))
        part.repartition(3).write.mode("append").json(source)
        stream.ingest(spark, source, table, events.schema, checkpoint, files_per_batch=2)
    return stream.current(spark, table, events.schema, ["user_id"], ["event_id"])


@query(
    """select user_id, max(event_id) as event_id from events group by user_id"""
)
def ingest_order(spark, sf):
    """Files without any column to order by: the last line of the last file of a user wins."""
    source, table, checkpoint = (new_path(spark, n) for n in ("arriving", "deltas", "offsets"))
    events = fx.table(spark, sf, "events").select("user_id", "event_id")
    middle = events.agg(F.max("event_id")).first()[0] // 2
    for part in (events.filter(F.col("event_id") <= middle), events.filter(F.col("event_id") > middle)):
        # files of one write are named in the order of their ranges
        files = part.repartitionByRange(3, "event_id").sortWithinPartitions("event_id")
        files.write.mode("append").json(source)
        stream.ingest(spark, source, table, events.schema, checkpoint)
    return stream.current(spark, table, events.schema, ["user_id"], list(stream.ARRIVAL))


@query(
    """select user_id, event_id, event_type from
 (select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
 where rn = 1 and user_id % 3 = 0"""
)
def stream_levels(spark, sf):
    """Events in ten batches, merged level by level; the last rows of every third user, from their buckets."""
    source, table, checkpoint = (new_path(spark, n) for n in ("arriving", "levels", "offsets"))
    events = fx.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    layout = levels.Layout(table, events.schema, ("user_id",), ("event_id",), buckets=8, fanout=3)
    events.repartition(10, "event_id").write.json(source)
    levels.ingest(spark, source, layout, checkpoint, files_per_batch=1)
    return levels.current(spark, layout, events.filter("user_id % 3 = 0").select("user_id"))


@query(
    f"""with cache as ({_CACHE_SQL}), fresh as ({_FRESH_SQL})
 select dir, count as n, strftime(as_of, '%Y-%m-%d') as as_of from cache
 union all select dir, n, '2024-03-01' from fresh"""
)
def dir_counts_cached(spark, sf):
    """The cache written as lines and read again before counting goes on."""
    path = new_path(spark, "count-cache")
    tables.write_count_cache(_cache(spark, sf).withColumnRenamed("count", "n"), path)
    today = F.lit("2024-03-01").cast("date")
    cache = tables.read_count_cache(spark, path)
    merged = audit.count_incrementally(documents(spark, sf), cache, ".en", today)
    return merged.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))


@query(
    """select 'source=' || source || '/' as dir, count(distinct lang) as n,
 case when source < (select max(source) from documents) then '2024-03-01' else '2024-03-02' end as as_of
 from documents group by source"""
)
def storage_counts(spark, sf):
    """Files counted on storage, one per source and language, in two runs: the second one lists
    only the directory that is new."""
    base, table = new_path(spark, "stored"), new_path(spark, "counts")
    rows = fx.table(spark, sf, "documents").select("source", "lang")
    last = rows.agg(F.max("source")).first()[0]
    for day, part in (("2024-03-01", rows.filter(F.col("source") != last)), ("2024-03-02", rows.filter(F.col("source") == last))):
        kept = part.distinct().withColumn("n", F.lit(1)).repartition("source", "lang")
        kept.write.mode("append").partitionBy("source", "lang").parquet(base)
        counts = jobs.count_directories(spark, base, table, ".parquet", F.lit(day).cast("date"))
    return counts.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))
