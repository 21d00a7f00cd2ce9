"""Upserts into a live catalog, and keyed deltas merged level by level."""

import json

import pytest
from pyspark.sql import functions as F

from tilewright import jobs
from tilewright.operators import derive, search, upsert
from tilewright.plans import fixtures as fx
from tilewright.sources import catalog, tables
from tilewright.staging import new_path, stage
from tilewright.streaming import levels

PARTITIONS = ("mission", "cell", "year")


def files_of(spark, path):
    """File names by partition, as they lie on storage."""
    rows = catalog.read_catalog(spark, path).select(*PARTITIONS, F.col("_metadata.file_name").alias("f")).distinct()
    out = {}
    for r in rows.collect():
        out.setdefault(tuple(r[:3]), set()).add(r["f"])
    return out


def logged(spark, path, version=None):
    rows = catalog.snapshot_files(spark, path, version).collect()
    return {tuple(r[:3]): set(r["files"]) for r in rows}


@pytest.fixture()
def live(spark, sf):
    path = new_path(spark, "live")
    catalog.write_catalog(stage(fx.items(spark, sf).filter("percent_valid_pixels < 4"), "items"), path)
    return path


def test_an_update_rewrites_its_old_and_new_partition_only(spark, live):
    items = stage(catalog.read_catalog(spark, live), "before")
    before = files_of(spark, live)
    one = items.orderBy("id").limit(1)
    row = one.first()
    old, new = (row["mission"], row["cell"], row["year"]), (row["mission"], row["cell"], 2099)
    moved = one.withColumns({"year": F.lit(2099), "platform": F.lit("moved")})
    assert upsert.upsert_partitions(spark, live, moved, ["id"]) == 1
    after = files_of(spark, live)
    assert {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)} == {old, new}
    assert logged(spark, live) == after and logged(spark, live, 0) == before
    assert {r["version"] for r in catalog.snapshot_files(spark, live).filter("year = 2099").collect()} == {1}
    rows = catalog.read_catalog(spark, live)
    assert rows.count() == items.count()
    assert [tuple(r) for r in rows.filter("platform = 'moved'").select("id", "year").collect()] == [(row["id"], 2099)]
    found = search.search(spark, live, bbox=tuple(row["bbox"]), prune="exact").select("id", "year")
    assert (row["id"], 2099) in {tuple(r) for r in found.collect()}
    extents = catalog.read_extents(spark, live)
    assert extents.agg(F.sum("n")).first()[0] == items.count()
    assert extents.count() == extents.select(*PARTITIONS).distinct().count() == len(after)


def test_partitions_left_empty_are_deleted_and_nothing_changes_without_updates(spark, live):
    items = stage(catalog.read_catalog(spark, live), "before")
    cell = items.groupBy(*PARTITIONS).count().filter("count = 1").orderBy(*PARTITIONS).first()
    assert upsert.upsert_partitions(spark, live, items.limit(0), ["id"]) == -1
    moved = items.filter((F.col("mission") == cell[0]) & (F.col("cell") == cell[1]) & (F.col("year") == cell[2]))
    upsert.upsert_partitions(spark, live, moved.withColumn("cell", F.lit("N90W180")), ["id"])
    assert not catalog.path_exists(spark, f"{live}/mission={cell[0]}/cell={cell[1]}/year={cell[2]}")
    assert tuple(cell[:3]) not in logged(spark, live)
    assert logged(spark, live) == files_of(spark, live)
    assert catalog.read_catalog(spark, live).count() == items.count()


def test_an_upsert_that_died_is_done_again(spark, live):
    """The new partition was in place, the old one not yet: the item lies in both."""
    items = stage(catalog.read_catalog(spark, live), "before")
    moved = items.orderBy("id").limit(1).withColumn("year", F.lit(2099))
    moved = stage(moved, "moved")
    half = moved.write.mode("append").partitionBy(*PARTITIONS)
    half.parquet(live)
    assert catalog.read_catalog(spark, live).count() == items.count() + 1
    upsert.upsert_partitions(spark, live, moved, ["id"])
    rows = catalog.read_catalog(spark, live)
    assert rows.count() == rows.select("id").distinct().count() == items.count()
    assert rows.filter("year = 2099").count() == 1


def test_single_items_are_put_into_a_live_catalog(spark, sf, live):
    derived = fx.derived(spark, sf).filter("error is null and percent_valid_pixels < 4").orderBy("id").limit(2)
    source = new_path(spark, "records")
    lines = [json.loads(r["line"]) for r in derive.item_lines(derived).collect()]
    changed, new = lines[0], dict(lines[1], id="new-item")
    changed["properties"]["platform"] = "again"
    spark.createDataFrame([(json.dumps(x),) for x in (lines[0], changed, new)], "line string").coalesce(1).write.text(source)
    n = catalog.read_catalog(spark, live).count()
    assert jobs.upsert_items(spark, source, live) == 1
    rows = stage(catalog.read_catalog(spark, live), "after")
    assert rows.count() == n + 1
    got = {r["id"]: r for r in rows.filter(F.col("id").isin(changed["id"], "new-item")).collect()}
    assert got[changed["id"]]["platform"] == changed["properties"]["platform"]
    want = derived.filter(F.col("id") == lines[1]["id"]).select("mission", "cell", "year", "ring").first()
    assert tuple(got["new-item"][c] for c in ("mission", "cell", "year", "ring")) == tuple(want)
    assert tables.read_item_lines(spark, source).count() == 3


def batch_rows(spark, number, keys=40):
    """Rows of one batch: every key of a stretch, some twice."""
    rows = [((7 * number + i) % keys, 100 * number + i) for i in range(15)] + [(number % keys, 100 * number + 50)]
    return [(k, v, f"f{number}", 0, i) for i, (k, v) in enumerate(rows)]


def test_batches_are_merged_level_by_level(spark):
    schema = spark.createDataFrame([], "key long, n long").schema
    layout = levels.Layout(new_path(spark, "levels"), schema, ("key",), buckets=4, fanout=3)
    last = {}
    for number in range(14):
        rows = batch_rows(spark, number)
        frame = spark.createDataFrame(rows, "key long, n long, _file string, _block long, _row long")
        levels.add_batch(frame, layout, number)
        last |= {k: v for k, v, *_ in rows}
    live = levels.runs(spark, layout)
    assert [(r.first, r.last, r.level) for r in live] == [(0, 8, 2), (9, 11, 1), (12, 12, 0), (13, 13, 0)]
    assert {tuple(r) for r in levels.current(spark, layout).collect()} == set(last.items())
    # a batch that is repeated, merged or not, changes nothing
    for number in (4, 13):
        again = spark.createDataFrame(batch_rows(spark, number), "key long, n long, _file string, _block long, _row long")
        levels.add_batch(again, layout, number)
    assert levels.runs(spark, layout) == live
    keys = spark.createDataFrame([(3,), (3,), (999,)], "key long")
    some = levels.current(spark, layout, keys)
    assert [tuple(r) for r in some.collect()] == [(3, last[3])]
    buckets = {r[0] for r in keys.select(layout.bucket()).collect()}
    pruned = levels.read_runs(spark, layout, live, sorted(buckets))
    plan = spark._jvm.PythonSQLUtils.explainString(pruned._jdf.queryExecution(), "formatted")
    assert plan.count("PartitionFilters: [bucket") == len(live)
    assert {r[0] for r in pruned.select("bucket").distinct().collect()} <= buckets


def test_a_merge_that_died_hides_or_keeps_its_parts(spark):
    schema = spark.createDataFrame([], "key long, n long").schema
    layout = levels.Layout(new_path(spark, "levels"), schema, ("key",), buckets=2, fanout=4)
    for number in range(3):
        frame = spark.createDataFrame(batch_rows(spark, number), "key long, n long, _file string, _block long, _row long")
        levels.add_batch(frame, layout, number)
    want = sorted(map(tuple, levels.current(spark, layout).collect()))
    parts = levels.runs(spark, layout)
    merged = levels.Run(0, 2, 1)
    levels._write(levels.read_runs(spark, layout, parts), layout, merged)  # parts not deleted yet
    assert levels.runs(spark, layout) == [merged]
    assert sorted(map(tuple, levels.current(spark, layout).collect())) == want
    levels.merge_levels(spark, layout)
    assert not any(catalog.path_exists(spark, r.path(layout.table)) for r in parts)
    catalog.delete_path(spark, f"{merged.path(layout.table)}/_SUCCESS")  # unfinished: not in force
    assert levels.runs(spark, layout) == []


def test_columns_are_found_by_the_schema_log(spark, sf):
    path, items = new_path(spark, "evolving"), stage(fx.items(spark, sf).filter("percent_valid_pixels = 5"), "items")
    catalog.write_catalog(items.filter("date_dt < 200"), path)
    more = items.filter("date_dt >= 200").withColumn("cloud", F.struct(F.lit(3).alias("low"), F.lit("x").alias("note")))
    catalog.write_catalog(more, path, mode="append")
    wider = F.struct(F.lit(4).alias("low"), F.lit(5.5).alias("high"))
    catalog.write_catalog(items.limit(1).withColumns({"id": F.lit("third"), "cloud": wider}), path, mode="append")
    read = catalog.read_catalog(spark, path, merge_schema=True)
    assert read.schema["cloud"].dataType.simpleString() == "struct<low:int,note:string,high:double>"
    rows = {r["id"]: r["cloud"] for r in read.select("id", "cloud").collect()}
    assert tuple(rows["third"]) == (4, None, 5.5) and sum(c is None for c in rows.values()) == items.filter("date_dt < 200").count()
    footers = spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)
    assert {f.name: f.dataType.simpleString() for f in footers.schema}.items() >= {"cloud": read.schema["cloud"].dataType.simpleString()}.items()
    # an upsert of items without the column keeps it in the items beside them
    upsert.upsert_partitions(spark, path, items.limit(1).withColumn("platform", F.lit("new")), ["id"])
    after = {r["id"]: r["cloud"] for r in catalog.read_catalog(spark, path, merge_schema=True).select("id", "cloud").collect()}
    changed = items.limit(1).first()["id"]
    assert after == rows | {changed: None}
    with pytest.raises(ValueError):
        catalog.write_catalog(items.withColumn("cloud", F.lit(1)), path, mode="append")
    assert catalog.read_catalog(spark, path).count() == len(rows)
