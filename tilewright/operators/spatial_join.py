"""Items, or the cells of a cell table, against many query geometries at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.functions.geometry import boxes_overlap, item_area, item_boxes, meets, ring_box
from tilewright.functions.held import Held, Rings
from tilewright.operators.skew import salted_join
from tilewright.staging import stage

# Query geometries are sent to every task only up to these counted sizes (some tens of MB);
# larger ones are shuffled.
TILES_LIMIT = 1_000_000
POINTS_LIMIT = 1_000_000


def _tile_span(low: Column, high: Column, degrees: float) -> tuple[Column, Column]:
    step = F.lit(float(degrees))
    return F.floor(low / step).cast("int"), F.floor(high / step).cast("int")


def _tiled(df: DataFrame, box: str, degrees: float) -> DataFrame:
    b = F.col(box)
    ty = F.explode(F.sequence(*_tile_span(b["ymin"], b["ymax"], degrees)))
    tx = F.explode(F.sequence(*_tile_span(b["xmin"], b["xmax"], degrees)))
    return df.withColumn("ty", ty).withColumn("tx", tx)


def _sizes(rois: DataFrame, degrees: float) -> tuple[int, int]:
    """Tiles and points of all query geometries, counted before anything is sent around."""
    b = F.col("bbox")
    y0, y1 = _tile_span(b["ymin"], b["ymax"], degrees)
    x0, x1 = _tile_span(b["xmin"], b["xmax"], degrees)
    tiles = (y1 - y0 + 1).cast("bigint") * (x1 - x0 + 1)
    points = F.aggregate("chains", F.lit(0), lambda n, c: n + F.size(c["points"]))
    row = rois.agg(F.sum(tiles).alias("tiles"), F.sum(points).alias("points")).first()
    return row["tiles"] or 0, row["points"] or 0


def box_join(
    items: DataFrame,
    rois: DataFrame,
    keep: tuple[str, ...],
    degrees: float = 1.0,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Pairs ``(roi_id, *keep, ring, item_box, roi_box, chains)`` whose boxes overlap, once each.

    ``items`` has ``ring, bbox``; ``rois`` has ``roi_id, chains, bbox``. Boxes of both sides
    are cut into small tiles and meet on equal tiles. A pair that meets in several tiles is
    kept only in the tile of the lower left corner of the overlap, so nothing has to be made
    distinct afterwards. A ring over 180 degrees has a box on either side. Few query geometries are broadcast and nothing is shuffled; many
    are shuffled by tile, with the rows of crowded tiles spread by a salt, and their shapes
    are joined back to the remaining pairs.
    """
    tiles, points = _sizes(rois, degrees)
    boxes = item_boxes(F.col("ring"), F.col("bbox"))
    left = items.select(*keep, "ring", boxes.alias("_boxes")).select(
        "*", F.explode("_boxes").alias("item_box"), F.col("_boxes")[0].alias("_first")
    )
    left = _tiled(left.drop("_boxes"), "item_box", degrees)
    right = _tiled(rois.select("roi_id", F.col("bbox").alias("roi_box")), "roi_box", degrees)
    spread = F.xxhash64(*keep)
    if tiles <= TILES_LIMIT:
        met = left.join(F.broadcast(right), ["tx", "ty"])
    else:
        met = salted_join(left, right.hint("merge"), ["tx", "ty"], spread, rows_per_task)
    a, b = F.col("item_box"), F.col("roi_box")
    step = F.lit(float(degrees))
    lower_left = (
        F.floor(F.greatest(a["xmin"], b["xmin"]) / step).cast("int") == F.col("tx")
    ) & (F.floor(F.greatest(a["ymin"], b["ymin"]) / step).cast("int") == F.col("ty"))
    overlap = boxes_overlap(a, b["xmin"], b["ymin"], b["xmax"], b["ymax"])
    # of an item with a box on either side of 180 degrees the second one counts where the first does not
    first = F.col("_first")
    new = (first["xmin"] == a["xmin"]) | ~boxes_overlap(first, b["xmin"], b["ymin"], b["xmax"], b["ymax"])
    pairs = met.filter(overlap & lower_left & new).drop("tx", "ty", "_first")
    shapes = rois.select("roi_id", "chains")
    if points <= POINTS_LIMIT:
        return pairs.join(F.broadcast(shapes), "roi_id")
    pairs = stage(pairs, "box-pairs")  # counted and joined: not computed twice
    return salted_join(pairs, shapes.hint("merge"), ["roi_id"], spread, rows_per_task)


def spatial_join(
    items: DataFrame,
    rois: DataFrame,
    keep: tuple[str, ...] = ("id",),
    degrees: float = 1.0,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Pairs ``(roi_id, *keep)`` of items and query geometries that intersect.

    Few query geometries, by the counted sizes of :func:`box_join`, are held whole by every task: an item goes to
    Python once, not once per pair, and comes back with all that it meets. With many, pairs stream through the exact test:
    no queue of rows with their shapes waits for its answers.
    """
    tiles, points = _sizes(rois, degrees)
    if tiles <= TILES_LIMIT and points <= POINTS_LIMIT:
        # boxes and shapes meet by id, as they do for many: an id that occurs twice counts each of its boxes with each shape
        shapes = rois.select("roi_id", "bbox").join(rois.select("roi_id", "chains"), "roi_id")
        if _sizes(shapes, degrees)[1] <= POINTS_LIMIT:
            return _held_join(items, shapes, keep)
    pairs = box_join(items, rois, keep, degrees, rows_per_task)
    found = pairs.select("roi_id", *keep, item_area(F.col("ring")).alias("_area"), F.col("chains").alias("_chains"))
    names = ["roi_id", *keep]

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = pa.array(meets(batch.column("_area"), batch.column("_chains")))
            yield batch.select(names).filter(hits)

    return found.mapInArrow(test, found.select(*names).schema)


def _held_join(items: DataFrame, shapes: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Pairs ``(roi_id, *keep)`` with ``shapes`` (``roi_id, bbox, chains``), which every task holds."""
    table = shapes.select("roi_id", "bbox", "chains").toArrow().combine_chunks()
    numbers, boxes, chains = (_one_array(table.column(n)) for n in ("roi_id", "bbox", "chains"))
    rows = items.select(*keep, F.col("ring").alias("_ring"), F.col("bbox").alias("_bbox"))
    met = T.StructField("_met", T.ArrayType(shapes.schema["roi_id"].dataType))
    schema = T.StructType([*rows.select(*keep).schema.fields, met])
    names = [*schema.names]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(chains, boxes)
        for batch in batches:
            if not batch.num_rows:
                continue
            kept = batch.select(list(range(len(names) - 1)))
            rings = Rings(batch.column(len(names) - 1), batch.column(len(names)))
            for i, r in held.met(rings):
                if len(i):  # pairs of a row lie together
                    begins = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(i)), pa.int32()), numbers.take(pa.array(r)))
                    some = kept.take(pa.array(i[begins]))
                    yield pa.record_batch([*some.columns, lists], names=names)

    return rows.mapInArrow(join, schema).select(F.explode("_met").alias("roi_id"), *keep)


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


# Containment modes of a cover.
MODES = ("center", "full", "overlap", "bbox_overlap")


def cover_by_table(
    rois: DataFrame, cells: DataFrame, modes: tuple[str, ...] = ("overlap",), degrees: float = 1.0
) -> DataFrame:
    """Rows ``(mode, roi_id, cell)`` by a cell table ``(cell, ring)``, such as a hexagon grid.

    Modes: ``center`` (the mean of the vertices lies in the geometry), ``full`` (the whole cell
    does, clear of its border), ``overlap`` (they intersect) and ``bbox_overlap`` (boxes do).
    All modes are answered from one join.
    """
    if unknown := set(modes) - set(MODES):
        raise ValueError(f"unknown containment modes {sorted(unknown)}")
    tasks = cells.sparkSession.sparkContext.defaultParallelism
    if len(cells.inputFiles()) < tasks:  # cells meet many geometries: a single small file would be worked off by one task
        cells = cells.repartition(4 * tasks)
    boxed = cells.select("cell", "ring", ring_box(F.col("ring")).alias("bbox"))
    pairs = box_join(boxed, rois, ("cell",), degrees)
    a, b, cell = F.col("item_box"), F.col("roi_box"), item_area(F.col("ring"))
    inside_box = (
        (a["xmin"] >= b["xmin"]) & (a["xmax"] <= b["xmax"])
        & (a["ymin"] >= b["ymin"]) & (a["ymax"] <= b["ymax"])
    )
    mean = F.struct(_mean_of("lon").alias("lon"), _mean_of("lat").alias("lat"))
    point = F.array(F.struct(F.lit(False).alias("area"), F.array(mean).alias("points")))
    shapes = {"_inside": inside_box, "_cell": cell, "_point": point, "_chains": F.col("chains")}
    wanted = {"full": ["_inside", "_cell", "_chains"], "overlap": ["_cell", "_chains"], "center": ["_point", "_chains"]}
    needed = {name for mode in modes for name in wanted.get(mode, [])}
    found = pairs.select("roi_id", "cell", *[shapes[n].alias(n) for n in shapes if n in needed])
    flags = [T.StructField(f"_{m}", T.BooleanType()) for m in modes]

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = held_modes(batch, modes)
            columns = [batch.column("roi_id"), batch.column("cell"), *[pa.array(held[m]) for m in modes]]
            yield pa.record_batch(columns, names=["roi_id", "cell", *[f"_{m}" for m in modes]])

    flagged = found.mapInArrow(test, T.StructType([found.schema["roi_id"], found.schema["cell"], *flags]))
    held = F.array_compact(F.array(*[F.when(F.col(f"_{m}"), F.lit(m)) for m in modes]))
    return flagged.select(F.explode(held).alias("mode"), "roi_id", "cell")


def held_modes(batch: pa.RecordBatch, modes: tuple[str, ...]) -> dict[str, np.ndarray]:
    """Per mode, which pairs of a cell and a query geometry hold. All modes share the tests they have in common."""
    held = {"bbox_overlap": np.ones(batch.num_rows, bool)}
    if "center" in modes:
        held["center"] = meets(batch.column("_point"), batch.column("_chains"))
    if {"overlap", "full"} & set(modes):
        held["overlap"] = meets(batch.column("_cell"), batch.column("_chains"))
    if "full" in modes:  # it meets the geometry, and not its boundary
        inside = batch.column("_inside").fill_null(False).to_numpy(zero_copy_only=False)
        held["full"] = np.zeros(batch.num_rows, bool)
        at = np.flatnonzero(inside & held["overlap"])
        outline = _outline(batch.column("_chains").take(pa.array(at)))
        held["full"][at] = ~meets(outline, batch.column("_cell").take(pa.array(at)))
    return held


def _outline(shapes: pa.ListArray) -> pa.ListArray:
    """The boundaries of geometries, without what they enclose."""
    points = shapes.values.field("points")
    lines = pa.StructArray.from_arrays([pa.array(np.zeros(len(points), bool)), points], ["area", "points"])
    return pa.ListArray.from_arrays(shapes.offsets, lines)


def _mean_of(axis: str) -> Column:
    """Mean of a ring's distinct vertices along one axis."""
    vertices = F.slice(F.col("ring"), 1, F.size("ring") - 1)
    total = F.aggregate(vertices, F.lit(0.0).cast("double"), lambda s, p: s + p[axis])
    return total / F.size(vertices)
