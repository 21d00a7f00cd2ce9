"""Whole jobs on a part of the granules."""

import struct

import pytest
from pyspark.sql import functions as F

from tilewright import jobs
from tilewright.functions import names
from tilewright.functions.geometry import geometries_meet
from tilewright.plans import fixtures as fx
from tilewright.sources import geoparquet as gp
from tilewright.staging import new_path, stage

ROI = {"type": "Polygon", "coordinates": [[[-60, 60], [-30, 60], [-30, 75], [-60, 75], [-60, 60]]]}


@pytest.fixture(scope="module")
def granules(spark, sf):
    return fx.granules(spark, sf).filter("k < 400").withColumn("url", names.s3_link(F.col("url")))


@pytest.fixture(scope="module")
def listing(granules):
    return granules.select(
        F.col("site").alias("region"), F.concat("prefix", F.lit("/"), "path_name").alias("key")
    )


def attributes(granules):
    return granules.drop("k", "c", "site", "prefix", "path_name")


def lines_of(spark, root):
    return sorted(tuple(r) for r in jobs.consolidated_years(spark, root).collect())


def manifest_of(spark, root, last):
    rows = jobs.manifest_of(spark, root, last).drop("timestamp").collect()
    return sorted(tuple(r) for r in rows)


def test_a_region_built_in_runs_equals_one(spark, granules, listing):
    """The first run ends within batches and misses keys in front; a reingest starts anew, and a
    run behind it neither repeats nor loses an item."""
    known, size = attributes(granules), 5
    once, often = new_path(spark, "once"), new_path(spark, "often")
    jobs.generate_items(spark, listing, known, once, fx.STORE, size)
    failed = spark.read.parquet(f"{once}/failed/run=0").count()
    want = sorted(value for _, _, value in lines_of(spark, once))
    assert failed > 0 and len(want) == 400 - failed
    ranks = listing.selectExpr("*", "row_number() over (partition by region order by key) as n")
    part = ranks.filter("n > 3 and n <= 47").drop("n")
    jobs.generate_items(spark, part, known, often, fx.STORE, size)
    after = jobs.generate_items(spark, listing, known, often, fx.STORE, size)
    assert sorted(v for _, _, v in lines_of(spark, often)) == want
    assert after.agg(F.sum("total_files_processed")).first()[0] == 400
    jobs.generate_items(spark, part, known, often, fx.STORE, size, reingest=True)
    jobs.generate_items(spark, listing, known, often, fx.STORE, size)
    assert sorted(v for _, _, v in lines_of(spark, often)) == want
    assert jobs.generate_items(spark, listing, known, often, fx.STORE, size).count() == 5
    assert sorted(v for _, _, v in lines_of(spark, often)) == want


def test_a_lost_manifest_is_rebuilt(spark, granules, listing):
    root = new_path(spark, "lost")
    jobs.generate_items(spark, listing, attributes(granules), root, fx.STORE, 5)
    whole = manifest_of(spark, root, 0)
    assert not jobs.repair_manifest(spark, root).filter("out_of_sync").count()
    kept = jobs.manifest_of(spark, root, 0).filter("chunk < 1")
    stage(kept, "kept").write.mode("overwrite").parquet(f"{root}/manifest/run=0")
    assert jobs.repair_manifest(spark, root).filter("out_of_sync").count()
    assert manifest_of(spark, root, 0) == whole


def test_chunks_of_another_build_are_taken_in(spark, granules, listing):
    """A synced build holds all lines once, and goes on behind the numbers it took in."""
    known = attributes(granules)
    source, root, new = (new_path(spark, n) for n in ("source", "root", "new"))
    jobs.generate_items(spark, listing, known, source, fx.STORE, 5)
    assert jobs.sync_chunks(spark, new_path(spark, "nothing"), new).count() == 0
    taken = jobs.sync_chunks(spark, source, new)
    assert lines_of(spark, new) == lines_of(spark, source)
    assert manifest_of(spark, new, 0) == manifest_of(spark, source, 0)
    assert taken.agg(F.sum("lines")).first()[0] == len(lines_of(spark, source))
    assert jobs.sync_chunks(spark, source, new).count() == 0 and jobs._last_run(spark, new) == 0
    after = jobs.generate_items(spark, listing, known, new, fx.STORE, 5)  # only the failed ones are left
    assert lines_of(spark, new) == lines_of(spark, source)
    assert after.agg(F.sum("total_files_processed")).first()[0] == 400
    # a build with a part of the keys: its own chunks stay, numbers it lacks are added
    part = listing.selectExpr("*", "row_number() over (partition by region order by key) as n")
    jobs.generate_items(spark, part.filter("n <= 10").drop("n"), known, root, fx.STORE, 5)
    mine = {r[:3] for r in manifest_of(spark, root, 0)}
    taken = jobs.sync_chunks(spark, source, root)
    numbers = {tuple(r)[:3] for r in taken.selectExpr("region", "year", "chunk").collect()}
    both = jobs._chunks_of(spark, root, 0, 1).select("region", "year", "chunk").distinct().collect()
    theirs = jobs._chunks_of(spark, source, 0, 0).select("region", "year", "chunk").distinct().collect()
    assert len(both) == len(set(map(tuple, both))) and set(theirs) <= set(both)
    assert numbers and len(numbers) + len(mine) == len(both)


def test_build_from_a_file_list_and_search_it(spark, granules):
    files = granules.select("prefix", F.col("path_name").alias("path"))
    target = new_path(spark, "files")
    totals = jobs.generate_items_from_files(spark, files, granules.drop("k", "c"), target, fx.STORE)
    row = totals.first()
    assert row["expected"] == 400 and row["mismatch"] and row["processed"] < 400
    failed = {r["error"] for r in spark.read.parquet(f"{target}/failed").collect()}
    assert "fewer than three dates in the name" in failed
    sidecars = spark.read.parquet(f"{target}/sidecars")
    assert sidecars.count() == 3 * row["processed"]
    found = jobs.search_items(
        spark, f"{target}/catalog", geojson={"type": "Feature", "geometry": ROI},
        percent_valid_pixels=20, epsg="3413", max_items=None,
        output=f"{target}/hrefs",
    )
    catalog = spark.read.parquet(f"{target}/catalog").filter(
        "percent_valid_pixels >= 20 and `proj:code` = 'EPSG:3413'"
    )
    rings = {
        r["href"]: [[p["lon"], p["lat"]] for p in r["ring"]]
        for r in catalog.select("ring", F.expr("assets['data'].href").alias("href")).collect()
    }
    want = sorted(
        h for h, ring in rings.items()
        if geometries_meet({"type": "Polygon", "coordinates": [ring]}, ROI)
    )
    assert [r["href"] for r in found.collect()] == want and want
    assert sorted(r[0] for r in spark.read.text(f"{target}/hrefs").collect()) == want
    near = jobs.search_items(spark, f"{target}/catalog", granule=granules.limit(1))
    assert near.count() >= 1
    with pytest.raises(ValueError):
        jobs.search_items(spark, f"{target}/catalog")
    with pytest.raises(ValueError):
        jobs.search_items(spark, f"{target}/catalog", granule=granules.limit(2))


def polygon_wkb(ring, order="<"):
    head = struct.pack(f"{order}BIII", 1 if order == "<" else 0, 3, 1, len(ring))
    return head + b"".join(struct.pack(f"{order}2d", *p) for p in ring)


def test_geoparquet_directories(spark):
    square = [(-50.0, 62.0), (-49.0, 62.0), (-49.0, 63.0), (-50.0, 63.0), (-50.0, 62.0)]
    far = [(x + 40, y) for x, y in square]
    base = new_path(spark, "geo")
    assets = '{"data":{"href":"https://x/%s.nc"}}'
    rows = [(polygon_wkb(square), assets % "a", 60), (polygon_wkb(far, ">"), assets % "b", 60)]
    schema = "geometry binary, assets string, percent_valid_pixels int"
    for path, row in (("landsatOLI/N60W050", rows[0]), ("landsatOLI/N60W010", rows[1])):
        df = spark.createDataFrame([row], schema)
        df.withColumn("datetime", F.lit("2001-05-01").cast("timestamp")).write.parquet(f"{base}/{path}")
    paths = gp.latlon_directories(spark, base, ROI)
    assert [p.split("/")[-1] for p in paths] == ["N60W050"]
    every = gp.latlon_directories(spark, base, None)
    for dirs in (paths, every):
        found = gp.search_directories(
            spark, dirs, ROI, "2001-01-01/..",
            [{"op": ">=", "args": [{"property": "percent_valid_pixels"}, 1]}],
        )
        assert [r["href"] for r in found.collect()] == ["https://x/a.nc"]
    assert gp.search_directories(spark, every).count() == 2
    assert gp.hex_directories(spark, f"{base}/none", [1]) == []
    output = new_path(spark, "links")
    found = jobs.search_folders(
        spark, base, {"type": "Feature", "geometry": ROI}, datetime="2001-01-01/..",
        percent_valid_pixels=1, output=output,
    )
    assert [r["href"] for r in found.collect()] == ["https://x/a.nc"]
    assert [r[0] for r in spark.read.text(output).collect()] == ["https://x/a.nc"]
    assert jobs.search_folders(spark, base, ROI, percent_valid_pixels=61).count() == 0
    with pytest.raises(ValueError):
        jobs.search_folders(spark, base, ROI, layout="hex")


def test_items_are_ingested_by_id(spark, sf):
    from tilewright.sources import tables

    items = fx.derived(spark, sf).filter("error is null and k < 60")
    source, table, offsets = (new_path(spark, n) for n in ("src", "tab", "off"))
    tables.write_items(items, source, "site", mode="append")
    first = jobs.ingest_items(spark, f"{source}/*", table, offsets)
    n = items.count()
    assert first.count() == n
    changed = items.filter("k < 10").withColumn("platform", F.lit("changed"))
    tables.write_items(changed, source, "site", mode="append")
    second = jobs.ingest_items(spark, f"{source}/*", table, offsets)
    assert second.count() == n
    assert second.filter("properties.platform = 'changed'").count() == changed.count() > 0
