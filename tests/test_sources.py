"""Readers and writers on small files."""

import json

from pyspark.sql import functions as F

from tilewright.functions.geometry import geometry_box
from tilewright.plans import fixtures as fx
from tilewright.sources import catalog, tables
from tilewright.sources import geoparquet as gp
from tilewright.staging import new_path

ROI = {
    "type": "Polygon",
    "coordinates": [[[-64.36, -64.87], [-63.43, -65.66], [-61.56, -65.26], [-64.36, -64.87]]],
}


def test_query_geometries_of_geojson_files(spark, tmp_path):
    for name, value in (("a", {"type": "Feature", "geometry": ROI}), ("b", ROI), ("c", {"x": 1})):
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=1))
    rows = {r["roi_id"]: r for r in tables.read_rois(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.json", "b.json", "c.json"} and rows["c.json"]["problem"]
    assert all(tuple(rows[n]["bbox"]) == geometry_box(ROI) for n in ("a.json", "b.json"))
    assert len(rows["a.json"]["chains"][0]["points"]) == 4


def test_logs_and_caches_as_scripts_write_them(spark, tmp_path):
    (tmp_path / "log").write_text(
        "INPROGRESS|a.ndjson|2024-01-01 00:00:00\n"
        "CHUNK_FAILED|a.ndjson|2024-01-01 00:01:00|chunk_2_failed: {x|y}\n"
        "FAILED|b.ndjson|2024-01-01 00:00:00|download_failed\n"
        "COMPLETED|c.ndjson|2024-01-01 00:00:00|2024-01-01 00:05:00|120|300\n"
        "COMPLETED_WITH_ERRORS|a.ndjson|2024-01-01 00:00:00|2024-01-01 00:09:00|10|9|1 failed chunks\n"
    )
    rows = {(r["status"], r["file"]): r for r in tables.read_progress(spark, str(tmp_path / "log")).collect()}
    assert rows["CHUNK_FAILED", "a.ndjson"]["note"] == "chunk_2_failed: {x|y}"
    assert rows["FAILED", "b.ndjson"]["note"] == "download_failed"
    assert rows["FAILED", "b.ndjson"]["end_ts"] is None
    assert rows["COMPLETED", "c.ndjson"]["items"] == 120
    assert rows["COMPLETED_WITH_ERRORS", "a.ndjson"]["note"] == "1 failed chunks"
    assert rows["INPROGRESS", "a.ndjson"]["start_ts"] == "2024-01-01 00:00:00"
    (tmp_path / "cache").write_text("a/b/:12:2024-01-02\n")
    assert tuple(map(str, tables.read_count_cache(spark, str(tmp_path / "cache")).first())) == (
        "a/b/", "12", "2024-01-02",
    )


def test_objects_on_storage_are_listed(spark, tmp_path):
    for name in ("x/a.nc", "x/b.png", "y/c.nc", "y/c.nc.premet"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("four")
    rows = tables.list_objects(spark, str(tmp_path)).collect()
    assert sorted(r["uri"].rsplit("/", 1)[-1] for r in rows) == ["a.nc", "c.nc"]
    assert {r["size"] for r in rows} == {4}


def test_chunk_files_named_as_files(spark, tmp_path):
    (tmp_path / "2020-chunk0001.ndjson").write_text('{"a":1}\n{"a":2}\n')
    (tmp_path / "notes.ndjson").write_text("x\n")
    rows = tables.read_chunk_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r["year"], r["chunk"], r["line"]) for r in rows] == [
        ("2020", 1, '{"a":1}'), ("2020", 1, '{"a":2}'),
    ]


def test_hex_directories_are_opened_by_number(spark):
    base = new_path(spark, "hex")
    for cell, x in ((577, 10.0), (578, 11.0)):
        df = spark.createDataFrame([(f"https://x/{cell}.nc",)], "href string")
        df.select(
            F.struct(F.struct("href").alias("data")).alias("assets"), F.lit(x).alias("longitude")
        ).write.parquet(f"{base}/{cell}")
    paths = gp.hex_directories(spark, base, [577, 999])
    found = gp.search_directories(spark, paths)
    assert [r["href"] for r in found.collect()] == ["https://x/577.nc"]
    assert len(gp.hex_directories(spark, base, None)) == 2


def test_appending_to_a_catalog_keeps_it_searchable(spark, sf):
    items = fx.items(spark, sf)
    path = new_path(spark, "growing")
    parts = [items.filter(f"mission {op} 'sentinel1'") for op in ("=", "<>")]
    for part in parts:
        catalog.write_catalog(part, path, ("mission", "cell"), mode="append")
    extents = catalog.read_extents(spark, path, ("mission", "cell"))
    assert extents.agg(F.sum("n")).first()[0] == items.count()
    assert catalog.read_catalog(spark, path, ("mission", "cell")).count() == items.count()
