"""Items and query geometries over the 180th meridian."""

import pytest
from pyspark.sql import functions as F

from tilewright.functions.geometry import boxes_on_map, item_boxes
from tilewright.operators import search, spatial_join
from tilewright.plans import fixtures as fx
from tilewright.sources import catalog
from tilewright.staging import new_path, stage

# name: western and eastern longitude (not wrapped), southern and northern latitude
PLACES = {"crossing": (179.5, 180.6, 10, 11), "west": (-179.2, -178.4, 10, 11), "east": (178.2, 178.9, 10, 11), "zero": (-1, 1, 10, 11)}


def wrapped(x):
    return x - 360 if x > 180 else float(x)


@pytest.fixture(scope="module")
def items(spark, sf):
    one = stage(fx.items(spark, sf).limit(1), "one").drop("id", "ring", "bbox", "cell")
    rows = []
    for name, (x0, x1, y0, y1) in PLACES.items():
        ring = [(wrapped(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
        xs = [x for x, _ in ring]
        rows.append((name, ring, (min(xs), float(y0), max(xs), float(y1)), "W180" if name == "crossing" else name))
    kind = "id string, ring array<struct<lon:double,lat:double>>, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, cell string"
    return stage(one.crossJoin(spark.createDataFrame(rows, kind)), "items")


SEARCHES = {
    (178.0, 9.0, 179.9, 12.0): {"crossing", "east"},
    (-179.9, 9.0, -179.0, 12.0): {"crossing", "west"},
    (170.0, 9.0, 190.0, 12.0): {"crossing", "east", "west"},
    (-190.0, 9.0, -170.0, 12.0): {"crossing", "east", "west"},
    (179.0, 9.0, 180.2, 12.0): {"crossing"},
    (-100.0, 9.0, 100.0, 12.0): {"zero"},
    (-180.0, 9.0, 180.0, 12.0): set(PLACES),
}


def test_searches_on_both_sides(spark, items):
    path = new_path(spark, "meridian")
    catalog.write_catalog(items.select(*[f"`{c}`" for c in catalog.ITEM_ROW.names], *catalog.LATLON_PARTITIONS), path)
    for box, want in SEARCHES.items():
        for prune in ("exact", "none"):
            found = search.search(spark, path, bbox=box, prune=prune).select("id").collect()
            assert {r["id"] for r in found} == want and len(found) == len(want), (box, prune)


def test_joins_on_both_sides(spark, items, monkeypatch):
    on_map = [(i, b) for i, box in enumerate(SEARCHES) for b in boxes_on_map({"type": "MultiPoint", "coordinates": [box[:2], box[2:]]})]
    rows = []
    for n, (i, (x0, y0, x1, y1)) in enumerate(on_map):
        ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        rows.append((f"{i}-{n}", [(True, ring)], (x0, y0, x1, y1)))
    kind = ("roi_id string, chains array<struct<area:boolean,points:array<struct<lon:double,lat:double>>>>,"
            " bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")  # fmt: skip
    rois = spark.createDataFrame(rows, kind)
    for limit in (1_000_000, 0):
        monkeypatch.setattr(spatial_join, "TILES_LIMIT", limit)
        monkeypatch.setattr(spatial_join, "POINTS_LIMIT", limit)
        pairs = [tuple(r) for r in spatial_join.spatial_join(items, rois).collect()]
        assert len(pairs) == len(set(pairs))
        for i, want in enumerate(SEARCHES.values()):
            assert {item for roi, item in pairs if roi.split("-")[0] == str(i)} == want


def test_an_item_over_the_meridian_has_few_tiles(spark, items):
    boxes = items.select("id", F.explode(item_boxes(F.col("ring"), F.col("bbox"))).alias("b"))
    tiles = {r["id"]: r["count"] for r in spatial_join._tiled(boxes, "b", 1.0).groupBy("id").count().collect()}
    assert tiles["crossing"] <= 8  # two degrees of latitude
