"""Checksums, year segments, counting and listing of storage, clustering of catalogs."""

import glob
import hashlib
import os
import pathlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tilewright import jobs, staging
from tilewright.functions.cells import place_key
from tilewright.operators import state, upsert
from tilewright.operators.derive import good_items
from tilewright.operators.sidecars import sidecars
from tilewright.plans import fixtures as fx
from tilewright.sources import catalog, geoparquet, listing, tables
from tilewright.staging import new_path, stage
from tests.test_jobs import attributes, granules  # noqa: F401
from tests.test_jobs import listing as object_listing  # noqa: F401


def test_checksums_of_chunks_larger_than_a_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = [
        (region, "2020", chunk, n, f"{region}-{chunk}-{n}-é" if n % 5 else " " * (n % 3))
        for region in "ab" for chunk in range(4) for n in range(3 + 17 * chunk)
    ]
    df = spark.createDataFrame(rows, "region string, year string, chunk int, line_no long, line string")
    got = {tuple(r[:3]): tuple(r[3:]) for r in state.chunk_stats(df.orderBy(F.rand(1))).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    want = {}
    for region, year, chunk in {r[:3] for r in rows}:
        lines = [r[4] for r in rows if r[:3] == (region, year, chunk)]
        text = "".join(x + "\n" for x in lines).encode()
        want[region, year, chunk] = (len(text), hashlib.md5(text).hexdigest(), sum(bool(x.strip(" ")) for x in lines))
    assert got == want
    assert state.chunk_stats(df.limit(0)).count() == 0


def test_later_runs_add_segments_and_rewrite_nothing(spark, granules, object_listing):  # noqa: F811
    root, known = new_path(spark, "segments"), attributes(granules)
    ranks = object_listing.selectExpr("*", "row_number() over (partition by region order by key) as n")
    parts = [ranks.filter(f).drop("n") for f in ("n <= 9", "n <= 20", "n <= 30")]
    jobs.generate_items(spark, parts[0], known, root, fx.STORE, 5)
    before = {f: open(f, "rb").read() for f in glob.glob(f"{root}/years/run=0/*/*/*.txt")}
    jobs.generate_items(spark, parts[1], known, root, fx.STORE, 5, consolidate=False)
    assert jobs.year_segments(spark, root).select("run").distinct().count() == 1
    jobs.generate_items(spark, parts[2], known, root, fx.STORE, 5)
    assert before == {f: open(f, "rb").read() for f in glob.glob(f"{root}/years/run=0/*/*/*.txt")} and before
    segments = jobs.year_segments(spark, root).collect()
    assert {r["run"] for r in segments} == {0, 2}
    for year in {(r["region"], r["year"]) for r in segments}:  # chunk numbers go on from segment to segment
        own = sorted((r["run"], r["first_chunk"], r["last_chunk"]) for r in segments if (r["region"], r["year"]) == year)
        assert all(a[2] < b[1] for a, b in zip(own, own[1:]))
    lines = jobs.consolidated_years(spark, root)
    assert lines.count() == sum(r["lines"] for r in segments)
    chunks = jobs._chunks_of(spark, root, 0, 2)
    assert sorted(r[0] for r in chunks.select("line").collect()) == sorted(r["value"] for r in lines.collect())


def tree(base, folders, files):
    for n in range(folders):
        path = base / f"d{n % 7}" / f"sub{n}"
        path.mkdir(parents=True)
        for k in range(files):
            (path / f"{k}.{'nc' if k % 2 == 0 else 'png'}").write_text("four")


def test_a_tree_of_many_folders_is_listed_in_many_tasks(spark, tmp_path, monkeypatch):
    tree(tmp_path, 600, 3)
    monkeypatch.setattr(listing, "DIRECTORIES_PER_TASK", 50)
    found = listing.list_tree(spark.createDataFrame([(str(tmp_path),)], "path string"))
    rows = stage(found, "found")
    assert rows.count() == 1800 and {r["size"] for r in rows.select("size").distinct().collect()} == {4}
    keys = rows.select(F.lit("r").alias("region"), F.col("path").alias("key"))
    kept = tables.filter_listing(keys, "b", "*.nc")
    plain = {p.split(str(tmp_path))[1] for p in glob.glob(f"{tmp_path}/**/*.nc", recursive=True)}
    assert {r["key"].split(str(tmp_path))[1] for r in kept.collect()} == plain and len(plain) == 1200
    empty = tmp_path / "empty"
    empty.mkdir()
    assert listing.list_tree(spark.createDataFrame([(f"file://{empty}",)], "path string")).count() == 0
    with pytest.raises(Exception):
        listing.list_tree(spark.createDataFrame([(f"{tmp_path}/none",)], "path string")).count()


def test_a_second_count_lists_new_directories_only(spark, tmp_path):
    base, table = tmp_path / "store", str(tmp_path / "counts")
    tree(base, 14, 4)
    (base / "none").mkdir()

    def count(day, **more):
        rows = jobs.count_directories(spark, str(base), table, ".nc", F.lit(day).cast("date"), **more).collect()
        return {r["dir"]: (r["n"], str(r["as_of"])) for r in rows}

    first = count("2024-01-01")
    assert first == {f"d{n}/": (4, "2024-01-01") for n in range(7)} | {"none/": (0, "2024-01-01")}
    (base / "d3" / "late.nc").write_text("x")  # counted directories are not listed again
    (base / "new").mkdir()
    (base / "new" / "a.nc").write_text("x")
    second = count("2024-01-03")
    assert second == first | {"new/": (1, "2024-01-03")}
    third = count("2024-01-04", max_age_days=2)
    assert third["d3/"] == (5, "2024-01-04") and third["new/"] == (1, "2024-01-03")
    (base / "new" / "a.nc").unlink()
    (base / "new").rmdir()
    assert "new/" in count("2024-01-04") and "new/" not in count("2024-01-04", drop_stale=True)
    (tmp_path / "counts" / "version=9").mkdir()  # a counting that died
    assert count("2024-01-04").keys() == first.keys()


def row_groups_met(path, box):
    """Row groups whose statistics do not rule out a box, and all of them."""
    met = every = 0
    for file in glob.glob(f"{path}/mission=*/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        place = {n: names.index(f"bbox.{n}") for n in ("xmin", "ymin", "xmax", "ymax")}
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(i).statistics for n, i in place.items()}
            every += 1
            met += (
                stats["xmin"].min <= box[2] and stats["xmax"].max >= box[0]
                and stats["ymin"].min <= box[3] and stats["ymax"].max >= box[1]
            )
    return met, every


def test_clustering_halves_the_row_groups_of_a_search(spark, sf):
    one = stage(fx.items(spark, sf).limit(1), "one").drop("bbox")
    rng = np.random.default_rng(1)
    boxes = [(float(x), float(y)) for x, y in rng.uniform((-55, 55), (-45, 65), (20000, 2))]
    items = one.crossJoin(spark.createDataFrame(boxes, "x double, y double"))
    box = [F.col("x").alias("xmin"), F.col("y").alias("ymin"), (F.col("x") + 0.3).alias("xmax"), (F.col("y") + 0.2).alias("ymax")]
    items = stage(items.withColumn("bbox", F.struct(*box)).drop("x", "y"), "many")
    spark.conf.set("parquet.block.size", "65536")
    clustered, sorted_by_x = new_path(spark, "clustered"), new_path(spark, "by-x")
    catalog.write_catalog(items, clustered)
    by_x = items.hint("rebalance", *[F.col(p) for p in catalog.LATLON_PARTITIONS])
    by_x = by_x.sortWithinPartitions(*catalog.LATLON_PARTITIONS, "bbox.xmin")
    by_x.write.partitionBy(*catalog.LATLON_PARTITIONS).parquet(sorted_by_x)
    spark.conf.unset("parquet.block.size")
    search = (-51.0, 58.0, -49.0, 60.0)
    (new, all_new), (old, all_old) = (row_groups_met(p, search) for p in (clustered, sorted_by_x))
    assert all_new > 40 and all_old > 40
    assert new / all_new <= old / all_old / 2


def test_place_keys_follow_a_curve(spark):
    """Every cell of a grid once, each a step away from the one before it."""
    rows = [(i, j, -180 + 360 / 16 * (i + 0.5), -90 + 180 / 16 * (j + 0.5)) for i in range(16) for j in range(16)]
    df = spark.createDataFrame(rows, "i int, j int, x double, y double")
    box = F.struct(F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"))
    path = df.select("i", "j", place_key(box, 4).alias("k")).orderBy("k").collect()
    assert [r["k"] for r in path] == list(range(256))
    assert all(abs(a["i"] - b["i"]) + abs(a["j"] - b["j"]) == 1 for a, b in zip(path, path[1:]))
    ends = spark.createDataFrame([(180.0, 90.0), (-180.0, -90.0)], "x double, y double").select(place_key(box))
    assert all(0 <= r[0] < 1 << 32 for r in ends.collect())


def test_files_are_sorted_by_columns(spark):
    """The place on the curve is not worked out anew at every comparison of a sort."""
    rows = spark.createDataFrame([("a", -50.0), ("b", 10.0), ("a", 70.0)], "mission string, x double")
    box = [F.col("x").alias("xmin"), F.lit(0.0).alias("ymin"), F.col("x").alias("xmax"), F.lit(1.0).alias("ymax")]
    ordered = catalog.in_file_order(rows.withColumn("bbox", F.struct(*box)), ["mission"])
    assert ordered.columns == ["mission", "x", "bbox"]
    sorts = [p for p in ordered._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort [" in p]
    assert len(sorts) == 1 and "aggregate(" not in sorts[0]
    assert {r["x"] for r in ordered.collect()} == {-50.0, 10.0, 70.0}


def test_item_lines_take_little_storage(spark, sf):
    """Item files are compressed, and read back as they were."""
    good = fx.derived(spark, sf).filter("error is null")
    sizes, read = {}, {}
    for kind in ("gzip", "none"):
        path = new_path(spark, "items")
        tables.write_items(good, path, "mission", **({} if kind == "gzip" else {"compression": kind}))
        files = glob.glob(f"{path.removeprefix('file:')}/mission=*/part-*")
        sizes[kind] = sum(os.path.getsize(f) for f in files)
        read[kind] = tables.read_item_lines(spark, path).select("id", "ring", "datetime").orderBy("id").collect()
    assert sizes["gzip"] < sizes["none"] / 4
    assert read["gzip"] == read["none"] and len(read["gzip"]) == good.count()


def test_directories_of_tasks_are_named_as_spark_names_them(spark, tmp_path):
    from tilewright.sources import files

    values = ["A", None, "", "a b", "x/y:z", 'q"%\'*=?', "{[^]}", "back\\slash", "é"]
    rows = spark.createDataFrame([(v, f"line {i}") for i, v in enumerate(values)], "region string, line string")
    rows.write.partitionBy("region").text(str(tmp_path / "spark"))
    placed = rows.select(files.partition_name("region").alias("directory"), "line")
    target = str(tmp_path / "tasks")
    files.write_directories(placed.repartition("directory").sortWithinPartitions("directory"), target, "text")
    files.write_directories(placed.repartition("directory").sortWithinPartitions("directory"), target, "text")
    names = [sorted(p.name for p in (tmp_path / d).iterdir() if p.is_dir()) for d in ("spark", "tasks")]
    assert names[0] == names[1]
    again = sorted(r["value"] for r in spark.read.schema("value string, region string").text(target).collect())
    assert again == sorted(2 * [f"line {i}" for i in range(len(values))])


def test_cells_have_a_file_each_and_all_are_found_without_the_schema_log(spark, tmp_path):
    from tilewright.sources import geoparquet as gp

    base = str(tmp_path / "hex")
    rows = spark.range(5000).selectExpr("id % 40 as cell", "id", "array(struct(id as a)) as nested")
    gp.write_cells(rows, base)
    assert [p.rsplit("/", 1)[1] for p in gp.hex_directories(spark, base, None)] == sorted(str(c) for c in range(40))
    paths = gp.hex_directories(spark, base, [7, 8, 99])
    assert paths == [f"{base}/7", f"{base}/8"]
    assert all(len(list((tmp_path / "hex" / str(c)).glob("*.parquet"))) == 1 for c in range(40))
    read = gp.read_directories(spark, paths, base)
    expected = rows.filter("cell in (7, 8)").drop("cell")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, expected.collect()))


def test_a_large_directory_is_cut_into_files(spark, tmp_path):
    from tilewright.plans.search_queries import _plain_directories

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        rows = spark.range(0, 40000, 1, 8).selectExpr("'m' as mission", "'c' as cell", "sha2(string(id), 256) as text")
        path = _plain_directories(spark, rows, ["mission", "cell"], "geo")
    finally:
        spark.conf.set(name, before)
    read = spark.read.parquet(f"{path}/m/c")
    assert read.count() == 40000 and len(read.inputFiles()) > 1


def test_sidecars_are_written_by_kind_without_a_sort(spark, tmp_path, monkeypatch):
    from tilewright.sources import tables

    rows = spark.range(0, 300, 1, 1).selectExpr("id", "element_at(array('stac', 'premet', 'spatial'), int(id % 3) + 1) as kind")
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    seen, written = [], type(rows.write).parquet

    def parquet(writer, path, *args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return written(writer, path, *args, **kwargs)

    monkeypatch.setattr(type(rows.write), "parquet", parquet)
    tables.write_sidecars(rows, str(tmp_path / "s"))
    assert seen and seen[0] > 3 and spark.conf.get(name) == before
    read = spark.read.parquet(str(tmp_path / "s"))
    assert {r["kind"]: r["count"] for r in read.groupBy("kind").count().collect()} == {"stac": 100, "premet": 100, "spatial": 100}


def test_cell_files_are_little_more_than_their_rows(spark):
    """A directory of a few rows holds no dictionaries, second schema or ranges of its texts (hex_search)."""
    rows = spark.range(40).select((F.col("id") % 10).alias("cell"), "id", *[F.concat(F.lit(f"{n}-" * 20), "id").alias(f"t{n}") for n in range(20)])
    base = new_path(spark, "cells")
    geoparquet.write_cells(rows, base)
    files = sorted(pathlib.Path(base).glob("[0-9]*/*.parquet"))
    assert len(files) == 10
    for file in files:
        footer = pq.ParquetFile(file).metadata
        group = footer.row_group(0)
        assert footer.serialized_size < 2600 and "ARROW:schema" not in str(footer.metadata)
        for i in range(footer.num_columns):
            column = group.column(i)
            assert column.compression == "ZSTD" and column.dictionary_page_offset is None
            assert column.is_stats_set == (column.physical_type == "INT64")  # numbers and times still prune
    again = geoparquet.read_directories(spark, [f"{base}/3", f"{base}/4"], base)
    assert sorted(r["id"] for r in again.collect()) == [x for x in range(40) if x % 10 in (3, 4)]


def test_many_rows_are_written_in_parts(spark, sf, monkeypatch):
    """Catalog (all_hrefs, catalog_upsert, partition_versions) and cells, a few partition values at a time, the same rows."""
    items = fx.items(spark, sf)
    monkeypatch.setattr(staging, "PART_BYTES", 1 << 10)
    parts = staging.in_parts(items, ["mission", "year"])
    assert len(parts) == staging.PARTS
    held = [{tuple(r) for r in part.select("mission", "year").distinct().collect()} for part in parts]
    assert sum(map(len, held)) == len(set().union(*held)) == items.select("mission", "year").distinct().count()
    path = new_path(spark, "parts")
    catalog.write_catalog(items, path)
    columns = ["id", "mission", "cell", "year", "platform"]
    assert sorted(map(repr, catalog.read_catalog(spark, path).select(*columns).collect())) == sorted(map(repr, items.select(*columns).collect()))
    assert catalog.read_extents(spark, path).agg(F.sum("n")).first()[0] == items.count()
    base = new_path(spark, "cells")
    geoparquet.write_cells(spark.range(100).select((F.col("id") % 20).alias("cell"), "id"), base)
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{base}/[0-9]*").count() == 100


def test_tables_are_packed_and_leave_no_shuffle_files(spark, sf):
    """Catalog, granules and sidecars (sidecar_targets) take little disk; settings are as before afterwards."""
    codec, clean = "spark.sql.parquet.compression.codec", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = [spark.conf.get(codec), spark.conf.get(clean)]
    path = new_path(spark, "packed")
    catalog.write_catalog(fx.items(spark, sf), path)
    good = good_items(fx.derived(spark, sf)).limit(20)
    tables.write_sidecars(sidecars(good), f"{path}-sidecars")
    for name in pathlib.Path(path).glob("mission=*/cell=*/year=*/*.parquet"):
        assert pq.ParquetFile(name).metadata.row_group(0).column(0).compression == "ZSTD"
    found = list(pathlib.Path(f"{path}-sidecars").glob("kind=*/*.parquet"))
    assert found and all(".zstd." in f.name for f in found)
    assert [spark.conf.get(codec), spark.conf.get(clean)] == before


def test_upsert_of_partitions_keeps_no_second_copy(spark, sf, monkeypatch):
    """The touched partitions of partition_upsert are merged on their way to the new files."""
    staged = []
    monkeypatch.setattr(upsert, "stage", lambda df, name: (staged.append(name), staging.stage(df, name))[1])
    items, path = fx.items(spark, sf).drop("cell"), new_path(spark, "live")
    catalog.write_catalog(items, path, ("mission", "year"))
    some = items.filter("percent_valid_pixels % 7 = 0").withColumn("platform", F.lit("new"))
    upsert.upsert_partitions(spark, path, some, ["id"], ("mission", "year"))
    assert "merged" not in staged
    got = catalog.read_catalog(spark, path, ("mission", "year"))
    assert got.count() == items.count() and got.filter("platform = 'new'").count() == some.count()
