"""Written intermediate tables, for cutting lineage in a way that survives lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of more than so many bytes, as the planner guesses them, are worked off in parts; so many at most.
PART_BYTES, PARTS = 1 << 30, 8


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tilewright-"))
    return context.getCheckpointDir().rstrip("/")


_HANDED_OUT: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete what this application has staged. Frames that read it can no longer be used."""
    while _HANDED_OUT:
        target = spark._jvm.org.apache.hadoop.fs.Path(_HANDED_OUT.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Steps inside leave no shuffle files behind, and the tables they write are packed tightly."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.parquet.compression.codec": "zstd"}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def in_parts(rows: DataFrame, keys) -> list[DataFrame]:
    """``rows`` in parts, each with all rows of its keys; one part unless they are many.

    What is worked out and shuffled part by part takes the disk of one part at a time. Rows are made anew for each, so
    they must come out the same every time.
    """
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # the planner's estimate
    n = min(PARTS, -(-size // PART_BYTES))
    if n <= 1:
        return [rows]
    part = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n))
    return [rows.filter(part == k) for k in range(n)]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: what follows is planned on columns, not on how they came about."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
