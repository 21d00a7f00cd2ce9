"""The cell-partitioned catalog: writing, reading, and the partition extents that prune it."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.functions.cells import place_key
from tilewright.schemas import BBOX, ITEM_ROW
from tilewright.staging import frugal, in_parts

LATLON_PARTITIONS = ("mission", "cell", "year")
PARTITION_TYPES = {"mission": T.StringType(), "cell": T.StringType(), "year": T.IntegerType()}
EXTENTS, LOG, SCHEMAS = "_extents", "_log", "_schemas"


def catalog_columns(items: DataFrame, partitions=LATLON_PARTITIONS) -> DataFrame:
    """Exactly the columns of a catalog row and its partition values."""
    return items.select(*[F.col(f"`{c}`") for c in ITEM_ROW.names], *partitions)


def write_catalog(
    items: DataFrame, path: str, partitions=LATLON_PARTITIONS, mode: str = "errorifexists"
) -> None:
    """Write items under ``mission/cell/year`` directories.

    The rebalance hint gathers each partition value into few files and lets the adaptive
    planner cut the ones that grow too large, so a cell holding a third of all items does
    not end up in one task. Rows are sorted along a space-filling curve within a file for row group pruning.
    Very many rows are gathered some partition values at a time (:func:`in_parts`), so that shuffle files never
    hold all of them; the extents come last, and a catalog without them is not finished.

    With ``mode="append"`` give a table rather than a computation: its extents are computed
    from it and added, so the rest of the catalog is not read. Should a job die between the
    two steps, :func:`write_extents` makes the extents anew.
    """
    if mode == "append":  # a changed type is refused before anything is written
        record_schema(items.sparkSession, path, items.drop(*partitions).schema)
    with frugal(items.sparkSession):
        for n, part in enumerate(in_parts(items, partitions)):
            (
                in_file_order(part, partitions)
                .write.mode("append" if n else mode)
                .option("partitionOverwriteMode", "static")
                .partitionBy(*partitions)
                .parquet(path)
            )
    if mode != "append":
        record_schema(items.sparkSession, path, items.drop(*partitions).schema)
    if mode == "append" and path_exists(items.sparkSession, f"{path}/{EXTENTS}"):
        extents = extents_of(items, partitions)
        extents.repartition(1).write.mode("append").parquet(f"{path}/{EXTENTS}")
    else:
        write_extents(items.sparkSession, path, partitions)


def in_file_order(rows: DataFrame, partitions) -> DataFrame:
    """Rows gathered by partition value, along the space-filling curve within a file.

    The place on the curve is a column while rows are sorted: as an expression of the order it would
    be worked out anew at every comparison.
    """
    gathered = rows.hint("rebalance", *[F.col(p) for p in partitions])
    placed = gathered.withColumn("_place", place_key(F.col("bbox")))
    return placed.sortWithinPartitions(*partitions, "_place").drop("_place")


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the fields of both, those of ``a`` first; fields meet by name.

    Raises ValueError where a field has two types.
    """
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = [
            T.StructField(f.name, merged_type(f.dataType, b[f.name].dataType) if f.name in b.names else f.dataType)
            for f in a.fields
        ]
        return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merged_type(a.keyType, b.keyType), merged_type(a.valueType, b.valueType))
    if a != b:
        raise ValueError(f"a column is {a.simpleString()} in some files and {b.simpleString()} in others")
    return a


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns that writes to a path have recorded, in order of their first appearance; or None."""
    target = f"{path}/{SCHEMAS}"
    if not path_exists(spark, target):
        return None
    rows = spark.read.schema("n int, schema string").parquet(target).orderBy("n").collect()  # one per change
    return reduce(merged_type, [T.StructType.fromJson(json.loads(r["schema"])) for r in rows]) if rows else None


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Record the columns of rows written to a path, unless they are known there.

    Fails on a column whose type has changed, before anything reads it.
    """
    known = logged_schema(spark, path)
    plain = merged_type(schema, schema)  # whether columns may be null is left out
    if known is not None and merged_type(known, plain) == known:
        return
    n = 0 if known is None else spark.read.parquet(f"{path}/{SCHEMAS}").count()
    row = spark.createDataFrame([(n, plain.json())], "n int, schema string")
    row.coalesce(1).write.mode("append").parquet(f"{path}/{SCHEMAS}")


def more_columns(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns of a catalog beyond those every item has, by its schema log."""
    known = logged_schema(spark, path)
    extra = [] if known is None else [f for f in known.fields if f.name not in ITEM_ROW.names]
    return T.StructType(extra) if extra else None


def write_extents(spark: SparkSession, path: str, partitions=LATLON_PARTITIONS) -> None:
    """Box, time span and count of every partition, as a small table inside the catalog.

    Reads only the box and time columns back.
    """
    rows = _read(spark, [path], path, _schema(partitions))
    extents_of(rows, partitions).repartition(1).write.mode("overwrite").parquet(f"{path}/{EXTENTS}")


def extents_of(rows: DataFrame, partitions=LATLON_PARTITIONS) -> DataFrame:
    """One row per partition value."""
    return rows.groupBy(*partitions).agg(
        F.count("*").alias("n"),
        F.struct(
            F.min("bbox.xmin").alias("xmin"),
            F.min("bbox.ymin").alias("ymin"),
            F.max("bbox.xmax").alias("xmax"),
            F.max("bbox.ymax").alias("ymax"),
        ).alias("bbox"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
    )


def _schema(partitions, extra: T.StructType | None = None) -> T.StructType:
    fields = list(ITEM_ROW.fields) + (list(extra.fields) if extra else [])
    return T.StructType(fields + [T.StructField(p, PARTITION_TYPES[p]) for p in partitions])


def _read(spark, paths, base, schema) -> DataFrame:
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def read_extents(spark: SparkSession, path: str, partitions=LATLON_PARTITIONS) -> DataFrame | None:
    """The extents table, or None for a catalog without one."""
    schema = T.StructType(
        [T.StructField(p, PARTITION_TYPES[p]) for p in partitions]
        + [
            T.StructField("n", T.LongType()),
            T.StructField("bbox", BBOX),
            T.StructField("first", T.TimestampType()),
            T.StructField("last", T.TimestampType()),
        ]
    )
    target = f"{path}/{EXTENTS}"
    return spark.read.schema(schema).parquet(target) if path_exists(spark, target) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether storage has the path, by Spark's own file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def child_directories(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory: one listing, bounded by the cells of a grid."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]


def read_catalog(
    spark: SparkSession,
    path: str,
    partitions=LATLON_PARTITIONS,
    only: list[tuple[str, ...]] | None = None,
    merge_schema: bool = False,
    extra: T.StructType | None = None,
) -> DataFrame:
    """Catalog rows, files matched by column name; columns a file lacks are null.

    ``only`` lists leading partition values to open, e.g. ``(mission, cell)`` pairs, of which the
    grid has about two thousand: exactly these directories are read, and the rest of the
    catalog is not even listed. ``merge_schema`` also finds columns that are
    not known beforehand, from the schema log; only a catalog without one has its footers opened.
    """
    paths = [path]
    if only is not None:
        paths = [
            "/".join([path, *[f"{p}={v}" for p, v in zip(partitions, values, strict=False)]])
            for values in only
        ]
    if only is not None and not only:
        return spark.createDataFrame([], _schema(partitions, extra))
    if merge_schema and extra is None and logged_schema(spark, path) is not None:
        rows = _read(spark, paths, path, _schema(partitions, more_columns(spark, path)))
    elif merge_schema:
        rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*paths)
    else:
        rows = _read(spark, paths, path, _schema(partitions, extra))
    return rows


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a directory of real storage; one that is not there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _log_schema(partitions) -> T.StructType:
    files = [T.StructField("files", T.ArrayType(T.StringType())), T.StructField("n", T.LongType())]
    return T.StructType(
        [*[T.StructField(p, PARTITION_TYPES[p]) for p in partitions], *files, T.StructField("version", T.IntegerType())]
    )


def last_version(spark: SparkSession, path: str) -> int:
    """Number of the last finished entry of a catalog's log; -1 before the first."""
    done = [
        int(name.removeprefix("version="))
        for name in child_directories(spark, f"{path}/{LOG}")
        if name.startswith("version=") and path_exists(spark, f"{path}/{LOG}/{name}/_SUCCESS")
    ]
    return max(done, default=-1)


def log_partitions(
    spark: SparkSession, path: str, only: list[tuple] | None = None, gone: list[tuple] = (), partitions=LATLON_PARTITIONS
) -> int:
    """Record the files of the partitions ``only`` (all, if None) and that those ``gone`` have none.

    An entry of the log has one row per partition; what it does not name is as the entry before
    left it. File names come from the files' own metadata, no column is read. Returns its number.
    """
    version = last_version(spark, path) + 1
    rows = read_catalog(spark, path, partitions, only=only).select(*partitions, F.col("_metadata.file_name").alias("_file"))
    found = rows.groupBy(*partitions, "_file").agg(F.count("*").alias("_n")).groupBy(*partitions)
    found = found.agg(F.sort_array(F.collect_list("_file")).alias("files"), F.sum("_n").alias("n"))
    fields = T.StructType(_log_schema(partitions).fields[:-1])
    empty = spark.createDataFrame([(*values, [], 0) for values in gone], fields)
    found.unionByName(empty).repartition(1).write.mode("overwrite").parquet(f"{path}/{LOG}/version={version}")
    return version


def read_log(spark: SparkSession, path: str, partitions=LATLON_PARTITIONS) -> DataFrame:
    """All finished entries: partition values, ``files, n, version``."""
    last = last_version(spark, path)
    if last < 0:
        return spark.createDataFrame([], _log_schema(partitions))
    entries = [f"{path}/{LOG}/version={n}" for n in range(last + 1)]
    return spark.read.schema(_log_schema(partitions)).option("basePath", f"{path}/{LOG}").parquet(*entries)


def snapshot_files(
    spark: SparkSession, path: str, version: int | None = None, partitions=LATLON_PARTITIONS
) -> DataFrame:
    """Partition values, ``files, n, version`` of the partitions that a version of the catalog has.

    ``version`` tells which entry last wrote a partition, so readers that remember theirs open
    only what has a higher one.
    """
    log = read_log(spark, path, partitions)
    log = log if version is None else log.filter(F.col("version") <= version)
    newest = log.groupBy(*partitions).agg(F.max_by(F.struct("files", "n", "version"), "version").alias("_last"))
    return newest.select(*partitions, "_last.*").filter(F.size("files") > 0)


def count_items(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a whole catalog, answered from file footers."""
    return read_catalog(spark, path).agg(F.count("*").alias("n"))
