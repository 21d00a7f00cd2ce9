"""Invariants of the operators on small inputs."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import held
from tilewright.functions.footprint import RING_FRACTIONS
from tilewright.functions.geometry import ring_box
from tilewright.operators import audit, derive, numbering, search, skew, spatial_join, state, upsert
from tilewright.operators.filters import conjunction
from tilewright.plans import fixtures as fx
from tilewright.plans import spatial_queries
from tilewright.plans.search_queries import NORTH
from tilewright.schemas import GRANULE
from tilewright.sources import catalog, tables
from tilewright.staging import new_path
from tilewright.streaming import ingest as stream


def pairs(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_pruning_loses_nothing(spark, sf):
    path = fx.catalog_path(spark, sf)
    found = {
        prune: {r["id"] for r in search.search(spark, path, intersects=NORTH, prune=prune).collect()}
        for prune in search.PRUNE
    }
    assert found["exact"] == found["none"] and found["home"] <= found["none"] and found["exact"]


def test_search_reaches_the_scan(spark, sf):
    df = search.search_hrefs(
        spark,
        fx.catalog_path(spark, sf),
        intersects=NORTH,
        datetime="1996-01-01/1997-12-31",
        filters=[{"op": ">=", "args": [{"property": "percent_valid_pixels"}, 50]}],
    )
    execution = df._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    assert "PartitionFilters: [isnotnull(year" in plan
    for pushed in ("LessThanOrEqual(bbox.xmin", "GreaterThanOrEqual(percent_valid_pixels,50)"):
        assert pushed in plan
    assert "scene_1_id" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_salting_does_not_change_a_join(spark):
    left = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    right = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right.filter("k % 5 <> 0"), ["k"], how)
        salted = skew.salted_join(
            left, right.filter("k % 5 <> 0"), ["k"], F.col("id"), rows_per_task=30, how=how
        )
        assert pairs(salted, *plain.columns) == pairs(plain, *plain.columns)


def test_spatial_join_by_any_tile_size_and_strategy(spark, sf, monkeypatch):
    items, rois = fx.items(spark, sf), fx.rois(spark, sf)
    coarse = pairs(spatial_join.spatial_join(items, rois, degrees=30.0), "roi_id", "id")
    fine = pairs(spatial_join.spatial_join(items, rois, degrees=0.5), "roi_id", "id")
    monkeypatch.setattr(spatial_join, "TILES_LIMIT", 0)
    monkeypatch.setattr(spatial_join, "POINTS_LIMIT", 0)
    salted = spatial_join.spatial_join(items, rois, degrees=1.0, rows_per_task=2)
    plan = spark._jvm.PythonSQLUtils.explainString(salted._jdf.queryExecution(), "simple")
    assert "SortMergeJoin" in plan and "_salt" in plan
    assert fine == coarse == pairs(salted, "roi_id", "id")
    assert len(fine) == len(set(fine)) > 0


def odd_shapes():
    """Items and query geometries on a coarse grid, so that many touch in corners and along edges."""
    rng = np.random.default_rng(11)

    def ring(x, y, r, n):
        turns = np.linspace(0, 2 * np.pi, n, endpoint=False)
        path = [(round((x + r * np.cos(t)) * 4) / 4, round((y + r * np.sin(t)) * 4) / 4) for t in turns]
        return [*path, path[0]]

    def box(points):
        xs, ys = [p[0] for p in points], [p[1] for p in points]
        return (min(xs), min(ys), max(xs), max(ys))

    items, rois = [], []
    for k in range(150):
        x, y, n = rng.uniform(-8, 8), rng.uniform(-8, 8), int(rng.choice([4, 16, 16, 90]))
        if k % 15 == 0:
            path = [((a + 180 + 180) % 360 - 180, b) for a, b in ring(x, y, 3, 8)]
        else:
            path = ring(x, y, rng.uniform(0.3, 3), n)
        items.append((f"i{k}", path, box(path)))
    items += [("none", None, (-9.0, -9.0, 9.0, 9.0)), ("empty", [], (-9.0, -9.0, 9.0, 9.0)), ("no box", items[1][1], None)]
    for k in range(120):
        x, y = rng.uniform(-8, 8), rng.uniform(-8, 8)
        if k % 12 == 0:
            x += 180
        outer = ring(x, y, rng.uniform(0.3, 4), 100 if k % 10 == 0 else 6)
        chains = [(True, outer)]
        if k % 3 == 0:
            chains.append((True, ring(x, y, 0.3, 4)))
        if k % 7 == 0:
            chains = [(False, outer[:3]), (False, [(x, y)])]
        rois.append((k, chains, box([p for _, c in chains for p in c])))
    rois += [rois[5], rois[5], (6, rois[7][1], rois[7][2]), (None, rois[8][1], rois[8][2])]
    rois += [(900, rois[1][1], None), (901, None, rois[1][2]), (902, [], rois[1][2])]
    return items, rois


def test_held_geometries_join_as_streamed_pairs(spark, monkeypatch):
    point = "array<struct<lon:double,lat:double>>"
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    items, rois = odd_shapes()
    items = spark.createDataFrame(items, f"id string, ring {point}, bbox {box}").repartition(3)
    rois = spark.createDataFrame(rois, f"roi_id int, chains array<struct<area:boolean,points:{point}>>, bbox {box}")
    for name, small in (("GROUP", 5), ("MATRIX", 400), ("BLOCK", 50), ("HANDED", 90)):
        monkeypatch.setattr(held, name, small)
    joined = spatial_join.spatial_join(items, rois)
    plan = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
    assert "Join" not in plan  # a ring goes to the test once, not with every pair
    found = pairs(joined, "roi_id", "id")
    monkeypatch.setattr(spatial_join, "TILES_LIMIT", 0)
    monkeypatch.setattr(spatial_join, "POINTS_LIMIT", 0)
    assert found == pairs(spatial_join.spatial_join(items, rois), "roi_id", "id")
    assert len(found) > 1000 and len(set(found)) < len(found) and any(i == "i0" for _, i in found)


def test_counts_per_geometry_move_no_pairs(spark, sf):
    counts = spatial_queries.roi_item_counts(spark, sf)
    plan = spark._jvm.PythonSQLUtils.explainString(counts._jdf.queryExecution(), "simple")
    assert "Join" not in plan
    want = collections.Counter(r["roi_id"] for r in spatial_queries.roi_join(spark, sf).collect())
    assert {r["roi_id"]: r["n"] for r in counts.collect()} == want


def test_row_numbers_of_a_hot_group(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 4).alias("g"),
        F.lpad((F.col("id") * 7919 % 5003).cast("string"), 5, "0").alias("key"),
    )
    got = {}
    for r in numbering.number_rows(rows, ["g"], ["key"]).collect():
        got.setdefault(r["g"], []).append((r["key"], r["row_no"]))
    for numbered in got.values():
        assert [n for _, n in sorted(numbered)] == list(range(1, len(numbered) + 1))
    assert sum(map(len, got.values())) == 5000


def chunk_by_hand(items, counters):
    """Counters advance with batches in which a year occurs."""
    out = {}
    for region in {r for r, _, _ in items}:
        for batch in sorted({b for r, b, _ in items if r == region}):
            years = {y for r, b, y in items if r == region and b == batch}
            for year in years:
                n = counters.get((region, year), 0)
                out[region, batch, year] = n
                counters[region, year] = n + 1
    return out


def test_chunks_of_two_runs_equal_one(spark):
    items = [(r, b, str(1990 + (b * k) % 5)) for r in "ab" for b in range(40) for k in (1, 3, 4)]
    df = spark.createDataFrame(items, "region string, batch long, year string")
    want = chunk_by_hand(items, {})
    got = numbering.number_chunks(df).distinct()
    assert {(r["region"], r["batch"], r["year"]): r["chunk"] for r in got.collect()} == want
    first = numbering.number_chunks(df.filter("batch < 17"))
    second = numbering.number_chunks(df.filter("batch >= 17"), state.counters(first))
    both = first.unionByName(second).distinct()
    assert {(r["region"], r["batch"], r["year"]): r["chunk"] for r in both.collect()} == want


def test_consolidated_files_keep_the_order(spark):
    lines = spark.range(3000).select(
        (F.col("id") % 2).cast("string").alias("region"),
        (F.lit(2000) + F.col("id") % 3).cast("string").alias("year"),
        (F.col("id") % 11).cast("int").alias("chunk"),
        F.col("id").alias("line_no"),
        F.format_string("%03d-%06d", F.col("id") % 11, "id").alias("line"),
    )
    path = new_path(spark, "consolidated")
    tables.consolidate(lines, path)
    read = spark.read.text(path).withColumn("file", F.input_file_name())
    rows = [(r["region"], str(r["year"]), r["file"], r["value"]) for r in read.collect()]
    for group in {r[:2] for r in rows}:
        files = sorted({r[2] for r in rows if r[:2] == group})
        joined = [r[3] for f in files for r in rows if r[2] == f]
        assert joined == sorted(joined)
    assert len(rows) == 3000


def test_upsert_takes_the_last_of_a_hot_key(spark):
    feed = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("n"),
    )
    got = {r["key"]: r["n"] for r in upsert.latest(feed, ["key"], ["n"]).collect()}
    assert got[1] == 2997 and len(got) == 2000
    base = spark.createDataFrame([(1, -1), (9999, -2)], "key long, n long")
    merged = {r["key"]: r["n"] for r in upsert.upsert(base, feed, ["key"], ["n"]).collect()}
    assert merged[1] == 2997 and merged[9999] == -2 and len(merged) == 2001


def test_stream_equals_batch_and_survives_a_repeated_batch(spark):
    rows = spark.range(500).select((F.col("id") % 40).alias("key"), F.col("id").alias("n"))
    source, table, offsets, snapshot = (new_path(spark, n) for n in ("in", "out", "cp", "snap"))
    rows.repartition(5, "n").write.json(source)
    stream.ingest(spark, source, table, rows.schema, offsets, files_per_batch=2)
    again = stream.deltas(spark, table, rows.schema).filter("batch_no = 0").drop("batch_no")
    copy = [tuple(r) for r in again.collect()]
    spark.createDataFrame(copy, again.schema).write.mode("overwrite").parquet(f"{table}/batch_no=0")
    got = stream.current(spark, table, rows.schema, ["key"], ["n"])
    want = upsert.latest(rows, ["key"], ["n"])
    assert pairs(got, "key", "n") == pairs(want, "key", "n")
    stream.compact(spark, table, rows.schema, ["key"], ["n"], snapshot)
    assert spark.read.parquet(snapshot).count() == 40
    base = spark.read.parquet(snapshot)
    stream.compact(spark, table, rows.schema, ["key"], ["n"], f"{snapshot}-2", base, retire=True)
    assert stream.deltas(spark, table, rows.schema).count() == 0
    kept = stream.current(spark, table, rows.schema, ["key"], ["n"], base)
    assert pairs(kept, "key", "n") == pairs(want, "key", "n")


def test_filters_that_say_nothing(spark):
    df = spark.createDataFrame([(5,), (None,)], "a int")
    assert df.filter(conjunction([])).count() == 2
    assert df.filter(conjunction([{}, {"op": ">=", "args": [{"property": "a"}, None]}])).count() == 2
    hostile = [{"op": "=", "args": [{"property": "b"}, "x' OR '1'='1"]}]
    assert df.withColumn("b", F.lit("x")).filter(conjunction(hostile)).count() == 0
    with pytest.raises(ValueError):
        conjunction([{"op": "like", "args": [1, 2]}])


def test_ring_stays_inside_the_extent(spark, sf):
    """Heights and widths of the ring points, read back in the granule's own projection."""
    ring = np.array(RING_FRACTIONS)
    assert ((ring >= 0) & (ring <= 1)).all() and len(ring) == 17
    assert ring[12:].tolist() == [[0, 1], [0, 0.75], [0, 0.5], [0, 0.25], [0, 0]]
    rows = derive.derive_items(fx.granules(spark, sf).limit(200)).filter("error is null").collect()
    for r in rows:
        assert len(r["ring"]) == 17 and r["ring"][0] == r["ring"][-1]


def test_ring_by_hand(spark):
    """One polar and one UTM granule on lines where the projection is plain: the meridian
    straight below the pole, and the central meridian at the equator."""
    attributes = {n: None for n in GRANULE.names}
    names = "LC08_L1TP_001001_20200101_20200102_02_T1_X_LC08_L1TP_001001_20200201_20200202_02_T1_G.nc"
    attributes |= {
        "url": f"s3://b/p/{names}", "id_img1": "LC08_L1TP", "id_img2": "LC08_L1TP", "date_dt": 31.0,
        "acquisition_date_img1": "20200101", "acquisition_date_img2": "20200201",
        "date_center": "20200116", "roi_valid_percentage": 50.0,
    }
    polar = attributes | {
        "spatial_epsg": 3413, "x_first": 120.0, "x_last": 239880.0, "y_first": -1000120.0,
        "y_last": -1239880.0, "geotransform": "0 240 0 -1000000 0 -240",
    }
    utm = attributes | {
        "spatial_epsg": 32633, "x_first": 500060.0, "x_last": 599940.0, "y_first": 99940.0,
        "y_last": 60.0, "geotransform": "500000 120 0 100000 0 -120",
    }
    rows = spark.createDataFrame([tuple(a[n] for n in GRANULE.names) for a in (polar, utm)], GRANULE)
    first, second = derive.derive_items(rows).select("error", "ring", "`proj:code`").collect()
    assert first["error"] is None and second["error"] is None
    # x = 0 is the meridian 45 W; the left side runs down it from y = -1000 km to -1240 km
    assert [p["lon"] for p in first["ring"][12:]] == [-45.0] * 5
    heights = [p["lat"] for p in first["ring"][12:]]
    assert heights == pytest.approx([80.7878, 80.2376, 79.6878, 79.1384, 78.5895], abs=1e-4)
    # x = 500 km is the central meridian 15 E; the left side runs from 100 km down to the equator
    assert [p["lon"] for p in second["ring"][12:]] == [15.0] * 5
    assert [p["lat"] for p in second["ring"][12:]] == pytest.approx([0.9046, 0.6785, 0.4523, 0.2262, 0], abs=2e-4)


def test_incomplete_granules_are_quarantined(spark):
    good = {n: None for n in GRANULE.names}
    good |= {
        "url": "s3://b/p/LC08_A_B_20200101_20200102_X_LC08_A_B_20200201_20200202.nc", "id_img1": "LC08_A",
        "id_img2": "LC08_B", "date_dt": 31.0, "acquisition_date_img1": "20200101",
        "acquisition_date_img2": "20200201", "date_center": "20200116", "roi_valid_percentage": 50.0,
        "spatial_epsg": 3413, "x_first": 0.0, "x_last": 240.0, "y_first": -1e6, "y_last": -1000240.0,
        "geotransform": "0 240 0 -1000000 0 -240",
    }
    nan = float("nan")
    faults = {
        None: {}, "no geometry": {"x_last": nan}, "missing attribute": {"id_img1": None},
        "unexpected platform": {"id_img1": "XX_1"}, "bad date": {"date_center": "never"},
    }
    rows = [tuple((good | f)[n] for n in GRANULE.names) for f in faults.values()]
    found = derive.derive_items(spark.createDataFrame(rows, GRANULE)).select("error").collect()
    assert [r["error"] for r in found] == list(faults)


def test_catalog_needs_no_listing_of_other_cells(spark, sf):
    path = fx.catalog_path(spark, sf)
    cells = [(r["mission"], r["cell"]) for r in catalog.read_extents(spark, path).collect()]
    some = sorted(set(cells))[:2]
    rows = catalog.read_catalog(spark, path, only=some)
    assert len({f.split("/mission=")[1].split("/year")[0] for f in rows.inputFiles()}) == 2
    assert catalog.read_catalog(spark, path, only=[]).count() == 0


def test_stale_cache_ages(spark):
    listing = spark.createDataFrame([("a", "a/1.nc"), ("b", "b/1.nc")], "dir string, key string")
    cache = spark.createDataFrame([("a", 9, "2024-01-01")], "dir string, count long, as_of string")
    today = F.lit("2024-01-05").cast("date")
    fresh = audit.uncounted(listing, cache, F.datediff(today, F.col("as_of").cast("date")) <= 1)
    assert fresh.count() == 2 and audit.uncounted(listing, cache).count() == 1


def test_state_is_sent_to_the_rows(spark):
    """A state that is computed does not bring all rows of a region to one task."""
    rows = spark.range(1000).selectExpr("if(id < 900, 'a', 'b') as region", "id div 10 as batch", "id as key")
    state = spark.range(10**8).filter("id in (17, 18)").groupBy(F.expr("if(id = 17, 'a', 'c') as region"))
    state = state.agg(F.max("id").alias("last_batch"))
    left = numbering.pending(rows, state)
    assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()
    assert left.count() == 1000 - 180 and left.columns == ["region", "batch", "key"]


def test_pairs_stream_through_the_exact_tests(spark):
    """No queue of rows with their shapes is kept beside Python, which went to disk with many pairs."""
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    ring = "array<struct<lon:double,lat:double>>"
    cells = [(0, square(1.0, 1.0, 1.0)), (1, square(3.5, 3.5, 1.0)), (2, square(4.0, 1.0, 1.0)), (3, square(8.0, 8.0, 1.0)), (4, square(0.0, 0.0, 4.0))]
    rois = [(7, [(True, square(0.0, 0.0, 4.0))], (0.0, 0.0, 4.0, 4.0)), (8, [(True, square(0.0, 0.0, 4.0)), (True, square(0.5, 0.5, 3.0))], (0.0, 0.0, 4.0, 4.0))]
    cells = spark.createDataFrame(cells, f"cell long, ring {ring}")
    rois = spark.createDataFrame(rois, f"roi_id long, chains array<struct<area:boolean,points:{ring}>>, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    cover = spatial_join.cover_by_table(rois, cells, spatial_join.MODES)
    held = {m: {(r["roi_id"], r["cell"]) for r in cover.collect() if r["mode"] == m} for m in spatial_join.MODES}
    assert held["bbox_overlap"] == {(r, c) for r in (7, 8) for c in (0, 1, 2, 4)}
    assert held["overlap"] == {(7, 0), (7, 1), (7, 2), (7, 4), (8, 1), (8, 2), (8, 4)}
    assert held["full"] == {(7, 0)}
    assert held["center"] == {(7, 0), (7, 1), (7, 4), (8, 1)}
    boxed = cells.select("cell", "ring", ring_box(F.col("ring")).alias("bbox"))
    joined = spatial_join.spatial_join(boxed, rois, keep=("cell",))
    assert pairs(joined, "roi_id", "cell") == sorted(held["overlap"])
    assert spatial_join.cover_by_table(rois, cells.coalesce(1)).rdd.getNumPartitions() > 1  # a small table is dealt over the tasks
    for frame in (cover, joined):
        plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
        assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
