"""Whole jobs: search, build from a file list, build a region batch by batch, ingest.

Each can be called with a session, or submitted: ``spark-submit tilewright/jobs.py search ...``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.geometry import box_geometry
from tilewright.functions.names import object_uri
from tilewright.operators import audit, derive, numbering, sidecars, state
from tilewright.functions.cells import home_cell
from tilewright.operators.search import search_granule, search_hrefs
from tilewright.operators.upsert import upsert_partitions
from tilewright.schemas import CHUNK_MANIFEST, COUNT_CACHE, ITEM_JSON, LISTING, REGION_STATE
from tilewright.session import configure
from tilewright.sources import listing as storage
from tilewright.sources import geoparquet, tables
from tilewright.sources.catalog import (
    catalog_columns,
    child_directories,
    delete_path,
    path_exists,
    write_catalog,
)
from tilewright.staging import release, stage
from tilewright.streaming import levels


def _filters(percent_valid_pixels: int | None, epsg: str | None) -> list[dict]:
    code = epsg if epsg is None or str(epsg).startswith("EPSG:") else f"EPSG:{epsg}"
    return [
        {"op": ">=", "args": [{"property": "percent_valid_pixels"}, percent_valid_pixels]},
        {"op": "=", "args": [{"property": "proj:code"}, code]},
    ]


def search_items(
    spark: SparkSession,
    catalog: str,
    granule: DataFrame | None = None,
    bbox=None,
    geojson: dict | None = None,
    datetime: str | None = None,
    percent_valid_pixels: int | None = None,
    epsg: str | None = None,
    max_items: int | None = None,
    output: str | None = None,
) -> DataFrame:
    """Links of items in a box, a GeoJSON geometry, or the box of one granule's attributes.

    All links, unless ``max_items`` says otherwise. ``granule`` has one row.
    """
    if granule is not None:
        rows = search_granule(granule).limit(2).collect()
        if len(rows) != 1:
            raise ValueError("a search starts from one granule; join several with spatial_join")
        if rows[0]["bbox"] is None or rows[0]["bbox"]["xmin"] is None:
            raise ValueError("the granule has no axes, or its projection is not supported")
        bbox = tuple(rows[0]["bbox"])
    if bbox is None and geojson is None:
        raise ValueError("give a granule, a box or a geometry")
    geometry = box_geometry(bbox) if bbox is not None else geojson
    links = search_hrefs(
        spark,
        catalog,
        intersects=geometry.get("geometry", geometry),
        datetime=datetime,
        filters=_filters(percent_valid_pixels, epsg),
        max_items=max_items,
    )
    if output is not None:
        tables.write_hrefs(links, output)
    return links


def _derived(files: DataFrame, granules: DataFrame) -> DataFrame:
    """Files ``(uri, ...)`` with the items of their granules; files without attributes fail."""
    known = granules.withColumn("uri", F.col("url"))
    joined = files.join(known, "uri", "left").withColumn("url", F.coalesce("url", "uri"))
    items = derive.derive_items(joined.withColumn("_known", F.col("id_img1").isNotNull()))
    return items.withColumn(
        "error", F.when(F.col("_known"), F.col("error")).otherwise(F.lit("no attributes"))
    ).drop("_known")


def generate_items_from_files(
    spark: SparkSession, files: DataFrame, granules: DataFrame, target: str, bucket: str
) -> DataFrame:
    """Build from a file list ``(prefix, path)``: items, sidecars, failures and the catalog.

    Returns expected and processed totals, observed while the derived rows are written. They are
    written once, and the outputs are made from them, so nothing is derived or counted twice.
    """
    listed = tables.with_years(files.select("prefix", "path")).withColumnRenamed("error", "_name")
    listed = listed.withColumnRenamed("year", "file_year").withColumn(
        "uri", object_uri(bucket, F.col("prefix"), F.col("path"))
    )
    keys = granules.drop("prefix", "path_name", "path")
    derived = _derived(listed, keys).withColumn("error", F.coalesce("_name", "error"))
    counted, totals = audit.observed(derived.drop("_name"))
    derived = stage(counted, "derived")
    good = derive.good_items(derived)
    by_file_year = good.drop("year").withColumnRenamed("file_year", "year")
    tables.write_items(by_file_year, f"{target}/items", "prefix", "year", mode="errorifexists")
    tables.write_sidecars(sidecars.sidecars(good), f"{target}/sidecars", mode="errorifexists")
    derive.quarantine(derived).write.parquet(f"{target}/failed")
    write_catalog(catalog_columns(good), f"{target}/catalog")
    return totals()


def _last_run(spark: SparkSession, root: str) -> int:
    """Number of the last finished run, by its success marker; -1 before the first."""
    runs = [
        int(n.removeprefix("run="))
        for n in child_directories(spark, f"{root}/state")
        if n.startswith("run=") and path_exists(spark, f"{root}/state/{n}/_SUCCESS")
    ]
    return max(runs, default=-1)


def first_run(spark: SparkSession, root: str, last: int) -> int:
    """The run that began what run ``last`` goes on with: a reingest begins anew."""
    return spark.read.schema("first int").parquet(f"{root}/generation/run={last}").first()[0]


def manifest_of(spark: SparkSession, root: str, last: int, first: int = 0) -> DataFrame:
    """Manifest rows of finished runs."""
    paths = [f"{root}/manifest/run={n}" for n in range(first, last + 1)]
    if not paths:
        return spark.createDataFrame([], CHUNK_MANIFEST)
    return spark.read.schema(CHUNK_MANIFEST).parquet(*paths)


def _chunks_of(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    schema = "chunk int, line_no string, line string, region string, year string"
    parts = [f"{root}/chunks/run={n}" for n in range(first, last + 1)]
    return spark.read.schema(schema).option("basePath", root).parquet(*parts)


def year_segments(spark: SparkSession, root: str) -> DataFrame:
    """The segments of the year files, ``region, year, run, first_chunk, last_chunk, lines``.

    Segments of a year in the order of ``run`` are its consolidated file: later runs have higher
    chunk numbers.
    """
    last = _last_run(spark, root)
    schema = "region string, year string, first_chunk int, last_chunk int, lines long, run int"
    runs = range(first_run(spark, root, last), last + 1) if last >= 0 else ()
    parts = [p for p in (f"{root}/segments/run={n}" for n in runs) if path_exists(spark, p)]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/segments").parquet(*parts)


def consolidated_years(spark: SparkSession, root: str) -> DataFrame:
    """``region, year, value``: the lines of all segments in force."""
    runs = [r["run"] for r in year_segments(spark, root).select("run").distinct().collect()]
    schema = "value string, run int, region string, year string"
    if not runs:
        return spark.createDataFrame([], "region string, year string, value string")
    parts = [f"{root}/years/run={n}" for n in sorted(runs)]
    rows = spark.read.schema(schema).option("basePath", f"{root}/years").text(parts)
    return rows.select("region", "year", "value")


def _consolidate(spark: SparkSession, root: str, first: int, run: int) -> None:
    """Add the chunks that no segment has yet as one more segment per region and year.

    Nothing written before is read or written again.
    """
    have = {n for n in range(first, run) if path_exists(spark, f"{root}/segments/run={n}")}
    since = max(have, default=first - 1) + 1  # runs without consolidation are caught up with
    lines = _chunks_of(spark, root, since, run)
    tables.consolidate(lines, f"{root}/years/run={run}", mode="overwrite")
    index = lines.groupBy("region", "year").agg(
        F.min("chunk").alias("first_chunk"), F.max("chunk").alias("last_chunk"), F.count("*").alias("lines")
    )
    index.repartition(1).write.mode("overwrite").parquet(f"{root}/segments/run={run}")


def repair_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Rebuilds the manifest from the stored chunks where it does not reach them all.

    Returns ``region, year, out_of_sync``. The rebuilt rows replace those of the last run; rows of
    runs before it are emptied only after that.
    """
    last = _last_run(spark, root)
    first = first_run(spark, root, last)
    stored = _chunks_of(spark, root, first, last)
    checked = stage(state.out_of_sync(stored, manifest_of(spark, root, last, first)), "checked")
    if not checked.filter("out_of_sync").isEmpty():
        rebuilt = state.rebuild_manifest(stored, state.chunk_stats(stored))
        rebuilt = rebuilt.withColumn("timestamp", F.current_timestamp().cast("string"))
        rebuilt = stage(rebuilt.select(*CHUNK_MANIFEST.names), "manifest")
        rebuilt.write.mode("overwrite").parquet(f"{root}/manifest/run={last}")
        for n in range(first, last):
            rebuilt.limit(0).write.mode("overwrite").parquet(f"{root}/manifest/run={n}")
    return checked.select("region", "year", "out_of_sync")


def _write_run(
    spark: SparkSession, root: str, run: int, first: int, lines: DataFrame, consolidate: bool
) -> None:
    """Chunks of a run, their manifest rows and, if wanted, their segments."""
    tables.write_chunks(lines, f"{root}/chunks/run={run}", mode="overwrite")
    written = _chunks_of(spark, root, run, run)
    manifest = state.manifest(state.chunk_stats(written)).withColumn(
        "timestamp", F.current_timestamp().cast("string")
    )
    manifest.select(*CHUNK_MANIFEST.names).write.mode("overwrite").parquet(
        f"{root}/manifest/run={run}"
    )
    if consolidate:
        _consolidate(spark, root, first, run)


def _close_run(
    spark: SparkSession, root: str, run: int, first: int, keys: DataFrame, after: DataFrame
) -> DataFrame:
    """The keys a run has processed, its generation, and the state last: the run counts from then on."""
    keys.select("region", "key").write.mode("overwrite").parquet(f"{root}/keys/run={run}")
    spark.range(1).select(F.lit(first).cast("int").alias("first")).write.mode("overwrite").parquet(
        f"{root}/generation/run={run}"
    )
    after.select(*REGION_STATE.names).write.mode("overwrite").parquet(f"{root}/state/run={run}")
    return spark.read.schema(REGION_STATE).parquet(f"{root}/state/run={run}")


def generate_items(
    spark: SparkSession,
    listing: DataFrame,
    granules: DataFrame,
    root: str,
    bucket: str,
    batch_size: int = 200,
    reingest: bool = False,
    consolidate: bool = True,
    progress: DataFrame | None = None,
) -> DataFrame:
    """Build regions from a listing ``(region, key)``, going on with the keys not yet processed.

    Keys of earlier runs are left out first, wherever they sort; the others are numbered behind the
    last batch, or behind ``counter`` of a ``progress`` record ``(region, counter)``. Outputs
    of a run lie under ``run=<n>``; the state is written last. A run that dies is done again under
    the same number and overwrites what it left. ``reingest`` begins a new generation, which
    owes nothing to the runs before. Returns the new state.
    """
    last = _last_run(spark, root)
    run = last + 1
    if reingest or last < 0:
        before, counters, first = state.reset_state(spark), None, run
        processed = spark.createDataFrame([], LISTING)
    else:
        first = first_run(spark, root, last)
        before = spark.read.schema(REGION_STATE).parquet(f"{root}/state/run={last}")
        counters = state.counters(manifest_of(spark, root, last, first))
        done = [f"{root}/keys/run={n}" for n in range(first, run)]
        processed = spark.read.schema(LISTING).parquet(*done)
    resumed = before if progress is None else state.resume_from(before, progress)
    objects = tables.filter_listing(listing, bucket, "*.nc")
    todo = numbering.remaining_batches(objects, processed, resumed, batch_size)
    derived = stage(_derived(todo.select("region", "key", "batch", "uri"), granules), "derived")
    good = derive.good_items(derived).withColumn("year", F.substring("mid_datetime", 1, 4))
    chunked = numbering.number_chunks(good, counters).withColumn("line_no", F.col("key"))
    lines = derive.item_lines(chunked, "region", "year", "chunk", "line_no")
    _write_run(spark, root, run, first, lines, consolidate)
    derive.quarantine(derived).write.mode("overwrite").parquet(f"{root}/failed/run={run}")
    return _close_run(spark, root, run, first, derived, state.advance(before, derived.select("region", "batch")))


def sync_chunks(spark: SparkSession, source: str, root: str, consolidate: bool = True) -> DataFrame:
    """Take in, as a run of its own, the chunks that the build in ``source`` stores and ``root`` lacks.

    Chunks are told apart by region, year and number and taken whole, as they are; a number that both
    have stays as it is in ``root``. Their keys count as processed, and the next build numbers its
    chunks behind them. Nothing missing, or no build in ``source``, writes no run. Returns
    ``region, year, chunk, lines`` of what was taken in. A sync that dies is done again whole.
    """
    there, last = _last_run(spark, source), _last_run(spark, root)
    run = last + 1
    first = first_run(spark, root, last) if last >= 0 else 0
    stored = "region string, year string, chunk int, line_no string, line string"
    none = spark.createDataFrame([], stored)
    remote = _chunks_of(spark, source, first_run(spark, source, there), there) if there >= 0 else none
    local = _chunks_of(spark, root, first, last) if last >= 0 else none
    missing = stage(state.missing_chunks(remote, local).select(*none.columns), "missing")
    taken = missing.groupBy("region", "year", "chunk").agg(F.count("*").alias("lines"))
    if missing.isEmpty():
        return taken
    before = spark.createDataFrame([], REGION_STATE)
    if last >= 0:
        before = spark.read.schema(REGION_STATE).parquet(f"{root}/state/run={last}")
    _write_run(spark, root, run, first, missing, consolidate)
    after = state.advance(before, missing.select("region", F.lit(None).cast("long").alias("batch")))
    after = after.withColumn("last_batch", F.coalesce("last_batch", F.lit(-1).cast("long")))
    _close_run(spark, root, run, first, missing.withColumnRenamed("line_no", "key"), after)
    return taken


def search_folders(
    spark: SparkSession,
    base: str,
    geojson: dict,
    layout: str = "latlon",
    cells: DataFrame | None = None,
    mode: str = "bbox_overlap",
    datetime: str | None = None,
    percent_valid_pixels: int | None = None,
    epsg: str | None = None,
    max_items: int | None = None,
    output: str | None = None,
) -> DataFrame:
    """Links in geoparquet directories named by degree cell, or by the numbers of a table of cells.

    ``layout`` is ``latlon`` (``<base>/<mission>/<cell>``) or ``hex`` (``<base>/<number>``); the
    latter needs ``cells`` with ``cell, ring`` and takes the cells that ``mode`` names.
    """
    geometry = geojson.get("geometry", geojson)
    query = {"datetime": datetime, "filters": _filters(percent_valid_pixels, epsg)}
    if layout == "latlon":
        links = geoparquet.search_latlon(spark, base, geometry, **query)
    elif layout == "hex" and cells is not None:
        links = geoparquet.search_hex(spark, base, cells, geometry, mode, **query)
    else:
        raise ValueError("a layout is latlon, or hex with a table of cells")
    if max_items is not None:
        links = links.limit(max_items)
    if output is not None:
        tables.write_hrefs(links, output)
    return links


def upsert_items(spark: SparkSession, source: str, catalog: str) -> int:
    """Put item NDJSON, one record or many, into a live catalog; the last line of an id counts.

    Rewrites only the partitions the items lie in or move to. Returns the log's entry.
    """
    rows = tables.read_item_lines(spark, source).withColumns(
        {
            "mission": derive.mission(F.col("platform")),
            "cell": home_cell(F.col("longitude"), F.col("latitude")),
            "year": F.col("year").cast("int"),
            "_line": F.monotonically_increasing_id(),
        }
    )
    return upsert_partitions(spark, catalog, rows, ["file", "_line"])


def _last_counts(spark: SparkSession, table: str) -> int:
    done = [
        int(n.removeprefix("version="))
        for n in child_directories(spark, table)
        if n.startswith("version=") and path_exists(spark, f"{table}/{n}/_SUCCESS")
    ]
    return max(done, default=-1)


def read_counts(spark: SparkSession, table: str) -> DataFrame:
    """The counts ``dir, count, as_of`` that the last finished counting left."""
    last = _last_counts(spark, table)
    if last < 0:
        return spark.createDataFrame([], COUNT_CACHE)
    return spark.read.schema(COUNT_CACHE).parquet(f"{table}/version={last}")


def count_directories(
    spark: SparkSession,
    base: str,
    table: str,
    extension: str = ".nc",
    today: Column | None = None,
    max_age_days: int | None = None,
    drop_stale: bool = False,
) -> DataFrame:
    """Files with an ending below each directory of ``base``, ``dir, n, as_of``, fewest first.

    Only directories without a count, or with one older than ``max_age_days``, are listed; the
    others' counts are kept with their dates. A new table takes the place of the old one when it
    is whole: readers look for the last finished version.
    """
    today = F.current_date() if today is None else today
    version = _last_counts(spark, table) + 1
    cache = read_counts(spark, table)
    dirs = storage.list_level(spark.createDataFrame([(base.rstrip("/"),)], "path string")).filter("is_dir")
    name = F.concat(F.substring_index("path", "/", -1), F.lit("/"))
    dirs = stage(dirs.select("path", name.alias("dir")), "directories")
    fresh = None if max_age_days is None else F.datediff(today, F.col("as_of")) <= max_age_days
    todo = stage(audit.uncounted(dirs, cache, fresh), "uncounted")
    files = storage.list_tree(todo.select("path"))
    inside = F.substring_index(F.substring(F.col("path"), len(base.rstrip("/")) + 2, 1 << 20), "/", 1)
    found = files.select(F.concat(inside, F.lit("/")).alias("dir"), F.col("path").alias("key"))
    none = todo.select("dir", F.lit("").alias("key"))  # a listed directory without any counts 0
    counts = audit.directory_counts(found.unionByName(none), extension)
    merged = audit.merge_counts(cache, counts, today)
    if drop_stale:
        merged = merged.join(dirs.select("dir"), "dir", "left_semi")
    out = merged.select("dir", F.col("n").alias("count"), "as_of")
    out.repartition(1).write.mode("overwrite").parquet(f"{table}/version={version}")
    if version >= 2:  # the one before stays for readers that have opened it
        delete_path(spark, f"{table}/version={version - 2}")
    return audit.by_count(read_counts(spark, table).withColumnRenamed("count", "n"))


def ingest_items(spark: SparkSession, source: str, table: str, checkpoint: str) -> DataFrame:
    """Take in new item NDJSON files; the last record per id, by batch, file and line, is current."""
    layout = levels.Layout(table, ITEM_JSON, ("id",))
    levels.ingest(spark, source, layout, checkpoint)
    return levels.current(spark, layout)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="scene catalog jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    find = jobs.add_parser("search")
    find.add_argument("--catalog", required=True)
    find.add_argument("--granule", help="table with the attributes of one granule")
    find.add_argument("--bbox")
    find.add_argument("--geojson")
    folders = jobs.add_parser("search-folders")
    for name in ("--base", "--geojson"):
        folders.add_argument(name, required=True)
    folders.add_argument("--layout", choices=("latlon", "hex"), default="latlon")
    folders.add_argument("--cells", help="table (cell, ring) of the hexagons that name the directories")
    folders.add_argument("--mode", default="bbox_overlap")
    for job in (find, folders):
        job.add_argument("--datetime")
        job.add_argument("--percent-valid-pixels", type=int)
        job.add_argument("--epsg")
        job.add_argument("--max-items", type=int)
        job.add_argument("--output", required=True)
    files = jobs.add_parser("build-files")
    region = jobs.add_parser("build-region")
    for job, source in ((files, "--file-list"), (region, "--listing")):
        job.add_argument(source, required=True)
        job.add_argument("--granules", required=True)
        job.add_argument("--target", required=True)
        job.add_argument("--bucket", required=True)
    region.add_argument("--batch", type=int, default=200)
    region.add_argument("--reingest", action="store_true")
    region.add_argument("--progress", help="table (region, counter): go on behind these batches")
    jobs.add_parser("repair-manifest").add_argument("--target", required=True)
    sync = jobs.add_parser("sync-chunks")
    for name in ("--source", "--target"):
        sync.add_argument(name, required=True)
    count = jobs.add_parser("count")
    for name in ("--base", "--table"):
        count.add_argument(name, required=True)
    count.add_argument("--extension", default=".nc")
    count.add_argument("--max-age", type=int)
    count.add_argument("--drop-stale", action="store_true")
    put = jobs.add_parser("upsert")
    for name in ("--source", "--catalog"):
        put.add_argument(name, required=True)
    take = jobs.add_parser("ingest")
    for name in ("--source", "--table", "--checkpoint"):
        take.add_argument(name, required=True)
    args = parser.parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"catalog {args.job}").getOrCreate())
    try:
        _run(spark, args)
    finally:
        release(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "search":
        geometry, granule = None, None
        if args.geojson:
            geometry = json.loads(spark.read.text(args.geojson, wholetext=True).first()[0])
        if args.granule:
            granule = tables.read_granules(spark, args.granule)
        search_items(
            spark, args.catalog, granule=granule, bbox=args.bbox, geojson=geometry,
            datetime=args.datetime, percent_valid_pixels=args.percent_valid_pixels,
            epsg=args.epsg, max_items=args.max_items, output=args.output,
        )
    elif args.job == "search-folders":
        geometry = json.loads(spark.read.text(args.geojson, wholetext=True).first()[0])
        cells = spark.read.parquet(args.cells) if args.cells else None
        search_folders(
            spark, args.base, geometry, args.layout, cells, args.mode, args.datetime,
            args.percent_valid_pixels, args.epsg, args.max_items, args.output,
        )
    elif args.job == "sync-chunks":
        sync_chunks(spark, args.source, args.target).show()
    elif args.job == "build-files":
        files_read = tables.read_file_list(spark, args.file_list)
        granules = tables.read_granules(spark, args.granules)
        generate_items_from_files(spark, files_read, granules, args.target, args.bucket).show()
    elif args.job == "build-region":
        listing = spark.read.schema(LISTING).parquet(args.listing)
        granules = tables.read_granules(spark, args.granules)
        progress = spark.read.parquet(args.progress) if args.progress else None
        generate_items(
            spark, listing, granules, args.target, args.bucket, args.batch, args.reingest, progress=progress
        ).show()
    elif args.job == "repair-manifest":
        repair_manifest(spark, args.target).show()
    elif args.job == "count":
        count_directories(
            spark, args.base, args.table, args.extension, max_age_days=args.max_age, drop_stale=args.drop_stale
        ).show(1000, truncate=False)
    elif args.job == "upsert":
        upsert_items(spark, args.source, args.catalog)
    else:
        ingest_items(spark, args.source, args.table, args.checkpoint)


if __name__ == "__main__":
    main()
