"""Catalogs of geoparquet files in plain directories: ``<base>/<mission>/<cell>/**`` or
``<base>/<hex cell number>/**``, geometry as well-known binary."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.functions.cells import MISSIONS, cover_names
from tilewright.functions.geometry import (
    BBOX_TYPE,
    CHAINS_TYPE,
    boxes_overlap,
    chain_dicts,
    chains_of,
    geometry_box,
    intersects_geometry,
)
from tilewright.operators.filters import conjunction, in_interval
from tilewright.operators.spatial_join import cover_by_table
from tilewright.schemas import BBOX, CHAINS
from tilewright.sources.catalog import child_directories, logged_schema, path_exists, record_schema
from tilewright.sources.files import write_directories
from tilewright.sources.listing import list_level
from tilewright.staging import frugal, in_parts

# Geometry codes of well-known binary.
_POINT, _LINE, _POLYGON = 1, 2, 3
_COLLECTIONS = (4, 5, 6, 7)


def wkb_chains_of(data: bytes) -> list[dict]:
    """Chains of one well-known binary geometry; further dimensions are skipped."""
    chains: list[dict] = []

    def points(at: int, order: str, width: int, n: int):
        size = 8 * width
        flat = struct.unpack_from(f"{order}{n * width}d", data, at)
        pairs = [{"lon": flat[i], "lat": flat[i + 1]} for i in range(0, n * width, width)]
        return pairs, at + n * size

    def read(at: int) -> int:
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(f"{order}I", data, at + 1)
        at += 5
        if code & 0x20000000:
            at += 4  # identifier of the coordinate system
        extra = bool(code & 0x80000000) + bool(code & 0x40000000)
        kind, thousands = code & 0xFFFF, (code & 0xFFFF) // 1000
        kind, width = kind % 1000, 2 + max(extra, (0, 1, 1, 2)[thousands])
        if kind == _POINT:
            pairs, at = points(at, order, width, 1)
            chains.append({"area": False, "points": pairs})
            return at
        (count,) = struct.unpack_from(f"{order}I", data, at)
        at += 4
        if kind == _LINE:
            pairs, at = points(at, order, width, count)
            chains.append({"area": False, "points": pairs})
        elif kind == _POLYGON:
            for _ in range(count):
                (n,) = struct.unpack_from(f"{order}I", data, at)
                pairs, at = points(at + 4, order, width, n)
                chains.append({"area": True, "points": pairs})
        elif kind in _COLLECTIONS:
            for _ in range(count):
                at = read(at)
        else:
            raise ValueError(f"unknown geometry code {code}")
        return at

    read(0)
    return chains


_SHAPE = T.StructType([T.StructField("chains", CHAINS), T.StructField("bbox", BBOX)])


def _plain_polygons(column: pa.Array) -> pa.Array | None:
    """Shapes of a column that holds polygons of one ring and one length only, without a loop."""
    if not len(column) or column.null_count:
        return None
    size = np.unique(pc.binary_length(column).to_numpy(zero_copy_only=False))
    if len(size) != 1 or size[0] < 13 + 16 * 4 or (size[0] - 13) % 16:
        return None
    n = int(size[0] - 13) // 16
    offset = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offset:][: len(column) * int(size[0])]
    raw = raw.reshape(len(column), -1)
    if not (raw[:, :13] == np.frombuffer(struct.pack("<BIII", 1, _POLYGON, 1, n), np.uint8)).all():
        return None
    x, y = np.ascontiguousarray(raw[:, 13:]).view("<f8").reshape(len(column), n, 2).transpose(2, 0, 1)
    points = pa.StructArray.from_arrays([pa.array(v.ravel()) for v in (x, y)], ["lon", "lat"])
    rings = pa.ListArray.from_arrays(np.arange(0, x.size + 1, n, dtype=np.int32), points)
    area = pa.array(np.ones(len(column), dtype=bool))
    chains = pa.StructArray.from_arrays([area, rings], ["area", "points"])
    chains = pa.ListArray.from_arrays(np.arange(len(column) + 1, dtype=np.int32), chains)
    ends = [pa.array(f(axis=1)) for f in (x.min, y.min, x.max, y.max)]
    box = pa.StructArray.from_arrays(ends, ["xmin", "ymin", "xmax", "ymax"])
    return pa.StructArray.from_arrays([chains, box], ["chains", "bbox"])


@F.arrow_udf(_SHAPE)
def _wkb_shape(column: pa.Array) -> pa.Array:
    if (plain := _plain_polygons(column)) is not None:
        return plain
    shapes = []
    for value in column:
        data = value.as_py()
        chains = [] if data is None else wkb_chains_of(data)
        path = [p for c in chains for p in c["points"]]
        if not path:
            shapes.append(None)
            continue
        lon, lat = [p["lon"] for p in path], [p["lat"] for p in path]
        box = {"xmin": min(lon), "ymin": min(lat), "xmax": max(lon), "ymax": max(lat)}
        shapes.append({"chains": chains, "bbox": box})
    return pa.array(shapes, type=pa.struct([("chains", CHAINS_TYPE), ("bbox", BBOX_TYPE)]))


def wkb_shape(geometry: Column) -> Column:
    """``struct<chains,bbox>`` of a well-known binary column; null for empty geometries."""
    return _wkb_shape(geometry)


def latlon_directories(spark, base: str, geometry: dict | None, missions=MISSIONS) -> list[str]:
    """Existing mission and cell directories that a geometry touches; all without one."""
    wanted = None if geometry is None else set(cover_names(geometry))
    if wanted and any(n.endswith("W180") for n in wanted):  # older files use both names
        wanted |= {n.replace("W180", "E180") for n in wanted}
    return [
        f"{base}/{m}/{c}"
        for m in missions
        for c in sorted(child_directories(spark, f"{base}/{m}"))
        if wanted is None or c in wanted
    ]


def hex_directories(spark, base: str, cells: list[int] | None) -> list[str]:
    """Existing directories of the cells of a hexagon cover, by their integer names.

    A grid may have many more cells than a cover, so names are compared in tasks and only those
    to open come to the driver.
    """
    if not path_exists(spark, base):
        return []
    listed = list_level(spark.createDataFrame([(base,)], "path string")).filter("is_dir")
    present = listed.select(F.substring_index("path", "/", -1).alias("name"))
    if cells is None:
        present = present.filter(~F.col("name").startswith("_"))  # the schema log
    else:
        wanted = spark.createDataFrame([(str(c),) for c in cells], "name string").distinct()
        present = present.join(wanted, "name", "left_semi")
    return [f"{base}/{r['name']}" for r in present.orderBy("name").collect()]


def write_directory(rows: DataFrame, base: str, name: str, mode: str = "append") -> None:
    """Write rows to ``<base>/<name>`` and record their columns in the base's schema log."""
    record_schema(rows.sparkSession, base, rows.schema)
    rows.write.mode(mode).parquet(f"{base}/{name}")


def write_cells(rows: DataFrame, base: str) -> None:
    """Append rows to ``<base>/<cell>``, a directory per hexagon cell, and record their columns."""
    kept = rows.drop("cell")
    record_schema(rows.sparkSession, base, kept.schema)
    cell = F.coalesce(F.col("cell").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    placed = rows.select(cell.alias("directory"), *[F.col(f"`{c}`") for c in kept.columns])
    with frugal(rows.sparkSession):
        for part in in_parts(placed, ["directory"]):
            write_directories(part.repartition("directory").sortWithinPartitions("directory"), base)


def read_directories(spark: SparkSession, paths: list[str], base: str | None = None) -> DataFrame:
    """Files of many directories as one table, matched by column name.

    With a ``base`` that has a schema log the columns come from it, and no footer is opened for them.
    """
    known = None if base is None else logged_schema(spark, base)
    if known is not None:
        return spark.read.schema(known).option("recursiveFileLookup", True).parquet(*paths)
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
    return reader.parquet(*paths)


_ASSETS = "map<string, struct<href: string, roles: array<string>>>"


def _asset_list(rows: DataFrame) -> Column:
    """All assets as an array of ``struct<href,roles>``, stored as map, struct or JSON text.

    An asset without roles has its own key as its role.
    """
    kind = rows.schema["assets"].dataType
    assets = F.col("assets")
    if isinstance(kind, T.StructType):
        fields = [
            F.struct(
                assets[f.name]["href"].alias("href"),
                (assets[f.name]["roles"] if "roles" in f.dataType.names else F.lit(None))
                .cast("array<string>").alias("roles"),
                F.lit(f.name).alias("key"),
            )
            for f in kind.fields
        ]
        found = F.array(*fields)
    else:
        as_map = F.from_json(assets, _ASSETS) if isinstance(kind, T.StringType) else assets
        found = F.transform(
            F.map_entries(as_map),
            lambda e: F.struct(
                e["value"]["href"].alias("href"), e["value"]["roles"].alias("roles"), e["key"].alias("key")
            ),
        )
    return F.transform(
        found,
        lambda a: F.struct(a["href"].alias("href"), F.coalesce(a["roles"], F.array(a["key"])).alias("roles")),
    )


def search_directories(
    spark: SparkSession,
    paths: list[str],
    intersects: dict | None = None,
    datetime: str | None = None,
    filters=None,
    suffix: str = ".nc",
    role: str = "data",
    base: str | None = None,
) -> DataFrame:
    """Sorted distinct data links of the matching rows of geoparquet directories.

    One query over all directories. Time and property tests reach the scan, and so does the
    box test where the files carry a ``bbox`` column; then shapes are decoded and tested.
    """
    if not paths:
        return spark.createDataFrame([], "href string")
    rows = read_directories(spark, paths, base).filter(in_interval(datetime) & conjunction(filters))
    if intersects is not None:
        box = geometry_box(intersects)
        if "bbox" in rows.columns and isinstance(rows.schema["bbox"].dataType, T.StructType):
            rows = rows.filter(boxes_overlap(F.col("bbox"), *box))
        rows = rows.withColumn("_shape", wkb_shape(F.col("geometry")))
        rows = rows.filter(boxes_overlap(F.col("_shape.bbox"), *box))
        rows = rows.filter(intersects_geometry(F.col("_shape.chains"), intersects))
    assets = rows.select(F.explode(_asset_list(rows)).alias("asset"))
    wanted = F.array_contains("asset.roles", role) & F.col("asset.href").endswith(suffix)
    links = assets.filter(wanted).select(F.col("asset.href").alias("href"))
    return links.distinct().orderBy("href")


def search_latlon(spark, base: str, intersects: dict, missions=MISSIONS, **query) -> DataFrame:
    """Links in the ``<base>/<mission>/<cell>`` directories that a geometry touches."""
    paths = latlon_directories(spark, base, intersects, missions)
    return search_directories(spark, paths, intersects, base=base, **query)


def search_hex(
    spark, base: str, cells: DataFrame, intersects: dict, mode: str = "bbox_overlap", **query
) -> DataFrame:
    """Links in the ``<base>/<cell number>`` directories of a cover by a cell table ``(cell, ring)``."""
    chains = chain_dicts(chains_of(intersects))
    box = geometry_box(intersects)
    roi = spark.createDataFrame(
        [("roi", chains, box)], T.StructType([T.StructField("roi_id", T.StringType()), *_SHAPE.fields])
    )
    cover = cover_by_table(roi, cells, (mode,)).select("cell").distinct().collect()  # the grid's at most
    paths = hex_directories(spark, base, [r["cell"] for r in cover])
    return search_directories(spark, paths, intersects, base=base, **query)
