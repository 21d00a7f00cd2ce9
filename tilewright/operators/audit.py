"""Counts, progress statistics and work lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tilewright.functions.names import first_directory
from tilewright.operators.upsert import latest

COMPLETED = "COMPLETED"
WITH_ERRORS = "COMPLETED_WITH_ERRORS"


def directory_counts(listing: DataFrame, extension: str, prefix: str | None = None) -> DataFrame:
    """Files with an ending per directory; a listed directory without any counts 0.

    ``listing`` has ``key`` and, without ``prefix``, ``dir``.
    """
    if prefix is not None:
        listing = listing.withColumn("dir", first_directory(F.col("key"), prefix)).filter(
            F.col("dir") != ""
        )
    hit = F.col("key").endswith(extension)
    return listing.groupBy("dir").agg(F.count_if(hit).cast("bigint").alias("n"))


def uncounted(listing: DataFrame, cache: DataFrame, max_age: Column | None = None) -> DataFrame:
    """Listing rows of directories whose count is not cached (or older than ``max_age`` allows)."""
    usable = cache if max_age is None else cache.filter(max_age)
    return listing.join(usable.select("dir"), "dir", "left_anti")


def merge_counts(cache: DataFrame, fresh: DataFrame, today: Column) -> DataFrame:
    """Cached and fresh counts; fresh ones win and get today's date."""
    new = fresh.select("dir", F.col("n").alias("_n"))
    return cache.join(new, "dir", "full_outer").select(
        "dir",
        F.coalesce("_n", "count").cast("bigint").alias("n"),
        F.when(F.col("_n").isNotNull(), today).otherwise(F.col("as_of")).alias("as_of"),
    )


def count_incrementally(
    listing: DataFrame, cache: DataFrame, extension: str, today: Column, drop_stale: bool = False
) -> DataFrame:
    """Count only directories without a cached count, then merge.

    ``drop_stale`` leaves out cached directories that are no longer listed.
    """
    fresh = directory_counts(uncounted(listing, cache), extension)
    merged = merge_counts(cache, fresh, today)
    return merged.join(listing.select("dir").distinct(), "dir", "left_semi") if drop_stale else merged


def by_count(counts: DataFrame) -> DataFrame:
    """Directories in ascending order of their count."""
    return counts.orderBy("n", "dir")


def completed_files(progress: DataFrame) -> DataFrame:
    """Files with any completed record; other states are done again."""
    return progress.filter(F.col("status") == COMPLETED).select("file").distinct()


def pending_files(listed: DataFrame, progress: DataFrame) -> DataFrame:
    return listed.join(completed_files(progress), "file", "left_anti")


def progress_stats(progress: DataFrame) -> DataFrame:
    """Records, items and seconds per status."""
    done = F.col("status").startswith(COMPLETED)
    return progress.groupBy("status").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.when(done, F.col("items"))), F.lit(0)).cast("bigint").alias("items"),
        F.coalesce(F.sum("secs"), F.lit(0)).cast("bigint").alias("secs"),
    )


def progress_totals(progress: DataFrame, latest_only: bool = False) -> DataFrame:
    """The closing statistics of a run.

    The plain total adds a file again each time it was completed with errors and redone;
    ``latest_only`` takes each file's last record instead.
    """
    if latest_only:
        progress = latest(progress, ["file"], ["end_ts", "start_ts", "status"])
    status = F.col("status")
    return progress.agg(
        F.count_if(status == COMPLETED).alias("completed"),
        F.count_if(status == WITH_ERRORS).alias("completed_with_errors"),
        F.count_if(status == "FAILED").alias("failed"),
        F.coalesce(F.sum(F.when(status.startswith(COMPLETED), F.col("items"))), F.lit(0))
        .cast("bigint")
        .alias("total_items"),
    )


def chunk_outcomes(chunks: DataFrame) -> DataFrame:
    """Chunks processed and failed per file. ``chunks`` has ``file, failed``."""
    failed = F.count_if(F.col("failed"))
    return chunks.groupBy("file").agg(
        F.count("*").alias("chunks_processed"),
        failed.alias("chunks_failed"),
        F.when(failed > 0, F.lit(WITH_ERRORS)).otherwise(F.lit(COMPLETED)).alias("status"),
    )


def prefix_year_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("prefix", "year").agg(F.count("*").alias("n"))


def totals_check(derived: DataFrame) -> DataFrame:
    """Expected against processed rows, and whether they differ."""
    return derived.agg(
        F.count("*").alias("expected"), F.count_if(F.col("error").isNull()).alias("processed")
    ).withColumn("mismatch", F.col("expected") != F.col("processed"))


def observed(derived: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The frame, and what :func:`totals_check` says of it once it has been written.

    The counts come with the write itself; the rows are not read for them.
    """
    seen = Observation()
    counted = derived.observe(
        seen, F.count(F.lit(1)).alias("expected"), F.count_if(F.col("error").isNull()).alias("processed")
    )

    def totals() -> DataFrame:
        found = seen.get
        row = (found["expected"], found["processed"], found["expected"] != found["processed"])
        return derived.sparkSession.createDataFrame([row], "expected long, processed long, mismatch boolean")

    return counted, totals


def collection_extent(items: DataFrame) -> DataFrame:
    """Box, interval and projection codes of a collection, computed from its items."""
    return items.groupBy("collection").agg(
        F.min("bbox.xmin").alias("xmin"),
        F.min("bbox.ymin").alias("ymin"),
        F.max("bbox.xmax").alias("xmax"),
        F.max("bbox.ymax").alias("ymax"),
        F.min("start_datetime").alias("start_datetime"),
        F.max("end_datetime").alias("end_datetime"),
        F.array_join(F.sort_array(F.collect_set("`proj:code`")), ",").alias("proj_codes"),
        F.count("*").alias("n"),
    )
