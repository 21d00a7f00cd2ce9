"""Listings of real storage as a distributed job: directories are expanded level by level."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.staging import new_path, stage

ENTRY = "path string, size long, modified timestamp, is_dir boolean"
# Directories that one task lists.
DIRECTORIES_PER_TASK = 64


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for uri in batch.column("path").to_pylist():
            files, path = fs.FileSystem.from_uri(uri)
            scheme = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
            found = files.get_file_info(fs.FileSelector(path, recursive=False))
            yield pa.record_batch(
                {
                    "path": pa.array([scheme + f.path for f in found], pa.string()),
                    "size": pa.array([f.size for f in found], pa.int64()),
                    "modified": pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                    "is_dir": pa.array([f.type == fs.FileType.Directory for f in found], pa.bool_()),
                }
            )


def list_level(directories: DataFrame) -> DataFrame:
    """What lies directly in each of the directories ``path``: ``path, size, modified, is_dir``.

    Paths are absolute, or addresses of any store the executors' Arrow knows (file, hdfs, s3, gs).
    A directory that is not there fails the job.
    """
    return directories.select("path").mapInArrow(_list, ENTRY)


def list_tree(directories: DataFrame) -> DataFrame:
    """All files at any depth: ``path, size, modified``.

    Every round lists the directories that the round before has found, in tasks of
    DIRECTORIES_PER_TASK, and writes what they hold; so there are as many rounds as levels, and
    neither the driver nor a task has to hold the listing.
    """
    spark = directories.sparkSession
    target = new_path(spark, "listing")
    frontier, level = stage(directories.select("path"), "frontier"), 0
    while (many := frontier.count()) or not level:
        tasks = many // DIRECTORIES_PER_TASK + 1
        path = f"{target}/level={level}"
        list_level(frontier.repartition(tasks)).write.parquet(path)
        frontier = spark.read.schema(ENTRY).parquet(path).filter("is_dir").select("path")
        level += 1
    rows = spark.read.schema(ENTRY).parquet(*[f"{target}/level={n}" for n in range(level)])
    return rows.filter(~F.col("is_dir")).drop("is_dir")
