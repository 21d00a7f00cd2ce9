"""Other inputs and outputs: file lists, listings, item lines, logs, query geometries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import names, times
from tilewright.functions.geometry import geojson_shape
from tilewright.operators.derive import from_lines, item_lines
from tilewright.operators.sidecars import SUFFIXES
from tilewright.schemas import COUNT_CACHE, FILE_LIST, GRANULE, ITEM_JSON, PROGRESS
from tilewright.sources.catalog import delete_path, path_exists
from tilewright.sources.files import partition_name, write_directories
from tilewright.staging import frugal


def read_granules(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return spark.read.schema(GRANULE).format(form).load(path)


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(prefix, path, year, error)`` of a parquet file list; splits follow row groups."""
    return with_years(spark.read.schema(FILE_LIST).parquet(path))


def with_years(files: DataFrame) -> DataFrame:
    """Year by the dates in the file name; names without enough dates are marked."""
    year = times.year_of_name(F.col("path"))
    found = F.size(times.name_dates(F.col("path")))
    error = (
        F.when(found < 3, F.lit("fewer than three dates in the name"))
        .when(year.isNull(), F.lit("bad date in the name"))
    )
    return files.withColumns({"year": year, "error": error})


def filter_listing(listing: DataFrame, bucket: str, pattern: str = "*") -> DataFrame:
    """Object addresses whose base name matches the glob and ends in ``.nc``."""
    key = F.col("key")
    kept = listing.filter(
        names.base_name(key).rlike(names.glob_to_regex(pattern)) & key.endswith(".nc")
    )
    return kept.withColumn("uri", F.concat(F.lit(f"s3://{bucket}/"), key))


def list_objects(spark: SparkSession, path: str, pattern: str = "*.nc") -> DataFrame:
    """Files below a path of real storage: ``(uri, size, modified)``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("path").alias("uri"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
        .filter(F.col("uri").endswith(".nc"))
    )


def read_item_lines(spark: SparkSession, path: str) -> DataFrame:
    """Catalog rows of NDJSON item files, with partition values and the file they came from."""
    parsed = spark.read.schema(ITEM_JSON).json(path)
    rows = from_lines(parsed.withColumn("file", F.col("_metadata.file_name")))
    return rows.withColumn("year", times.year_of_text(F.col("mid_datetime")))


def read_chunk_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of chunk files with year, number and place in the file; other files are skipped.

    The chunk is named by the file, ``2020-chunk0001.ndjson``, or by its directory,
    ``chunk_id=2020-chunk0001``. ``line_no`` orders the lines of one chunk.
    """
    place = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("value").alias("line"), place.alias("line_no"), F.col("_metadata.file_path").alias("at")
    )
    by_directory = F.regexp_extract("at", r"/chunk_id=([^/]+)/", 1)
    name = F.when(by_directory != "", by_directory).otherwise(names.base_name(F.col("at")))
    region = F.regexp_extract("at", r"/region=([^/]+)/", 1)
    return lines.select(
        region.alias("region"),
        names.chunk_year(name).alias("year"),
        names.chunk_number(name).alias("chunk"),
        "line_no",
        "line",
    ).filter(F.col("chunk").isNotNull())


def read_rois(spark: SparkSession, path: str) -> DataFrame:
    """Query geometries ``(roi_id, chains, bbox, problem)`` of GeoJSON files, one per file.

    Any geometry, feature or collection, with holes and parts. A file without a usable geometry is
    a row, too, with the reason in ``problem``; leave such rows out before a join.
    """
    text = spark.read.text(path, wholetext=True)
    shape = geojson_shape(F.col("value"))
    return text.select(F.col("_metadata.file_name").alias("roi_id"), shape.alias("shape")).select("roi_id", "shape.*")


# States whose log line is ``state|file|time|note``; the note may hold bars.
NOTED = ("FAILED", "CHUNK_FAILED")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A progress log. Lines have as many fields as their state needs; the rest is null."""
    line = F.col("value")
    short, full = F.split(line, r"\|", 4), F.split(line, r"\|", 7)
    noted = F.substring_index(line, "|", 1).isin(*NOTED)

    def field(i: int, name: str):
        value = F.when(~noted | F.lit(i < 4), F.try_element_at(full, F.lit(i)))
        return value.try_cast(PROGRESS[name].dataType).alias(name)

    note = F.when(noted, F.try_element_at(short, F.lit(4))).otherwise(
        F.try_element_at(full, F.lit(7))
    )
    fields = [field(i, n) for i, n in enumerate(PROGRESS.names[:-1], 1)]
    return spark.read.text(path).filter(line != "").select(*fields, note.alias("note"))


def append_progress(progress: DataFrame, path: str) -> None:
    """Append records as log lines: three fields when in progress, a note after failures."""
    noted, begun = F.col("status").isin(*NOTED), F.col("status") == "INPROGRESS"
    line = (
        F.when(begun, F.concat_ws("|", "status", "file", "start_ts"))
        .when(noted, F.concat_ws("|", "status", "file", "start_ts", "note"))
        .otherwise(F.concat_ws("|", "status", "file", "start_ts", "end_ts", "items", "secs", "note"))
    )
    progress.select(line.alias("line")).write.mode("append").text(path)


def read_count_cache(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNT_CACHE).option("sep", ":").csv(path)


def write_count_cache(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Counts ``dir, n, as_of`` as the lines ``dir:count:date`` that :func:`read_count_cache` reads."""
    line = F.concat_ws(":", "dir", F.col("n").cast("string"), F.date_format("as_of", "yyyy-MM-dd"))
    counts.select(line.alias("line")).write.mode(mode).text(path)


def write_items(
    items: DataFrame, path: str, *partitions: str, mode: str = "append", compression: str = "gzip"
) -> None:
    """Item NDJSON under ``partition=value`` directories, e.g. prefix and year, or mission
    and row group. Rows are rebalanced so that one large partition is several files, of which
    each is read by one task. Plain text (``compression="none"``) takes several times the storage."""
    lines = item_lines(items, *partitions).hint("rebalance", *[F.col(p) for p in partitions])
    lines.write.mode(mode).option("compression", compression).partitionBy(*partitions).text(path)


def write_chunks(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Chunk lines as a table partitioned by region and year, the chunk number a column.

    Chunks of a few hundred lines as files of their own would be millions of tiny objects;
    sorted by chunk, a chunk is a row range that min/max statistics find.
    """
    (
        lines.hint("rebalance", F.col("region"), F.col("year"))
        .sortWithinPartitions("region", "year", "chunk", "line_no")
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy("region", "year")
        .parquet(path)
    )


def write_chunk_files(lines: DataFrame, path: str, mode: str = "append") -> None:
    """One directory per region and chunk id with the chunk's lines in order, for export.

    A chunk is one batch at most, so it fits a task. Choose batches large enough for files.
    """
    if mode not in ("append", "overwrite", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode}")
    if mode != "append" and path_exists(lines.sparkSession, path):
        if mode == "ignore":
            return
        if mode != "overwrite":
            raise FileExistsError(path)
        delete_path(lines.sparkSession, path)
    out = lines.withColumn("chunk_id", names.chunk_id(F.col("year"), F.col("chunk")))
    placed = F.concat_ws("/", partition_name("region"), partition_name("chunk_id"))
    ordered = out.repartition("region", "chunk_id").sortWithinPartitions("region", "chunk_id", "line_no")
    write_directories(ordered.select(placed.alias("directory"), "line"), path, "text")


def consolidated(lines: DataFrame) -> DataFrame:
    """Chunk lines in the order of the consolidated year files.

    Range partitions keep the order of chunk and line within region and year, and split a
    year that is too large for one task.
    """
    order = ["region", "year", "chunk", "line_no"]
    return lines.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)


def consolidate(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write year files; a year's part files, in name order, are the consolidated file."""
    (
        consolidated(lines)
        .select("region", "year", "line")
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy("region", "year")
        .text(path)
    )


def write_hrefs(hrefs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Links, one per line, in order."""
    hrefs.select("href").write.mode(mode).text(path)


def write_sidecars(sidecars: DataFrame, path: str, mode: str = "append") -> None:
    """Sidecar texts as a table by kind; targets stay a column, not millions of small files.

    A task holds a file of every kind open, so the texts need not be sorted by kind before.
    """
    conf, name = sidecars.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(len(SUFFIXES) + 1))
    try:
        with frugal(sidecars.sparkSession):
            sidecars.write.mode(mode).partitionBy("kind").parquet(path)
    finally:
        conf.set(name, before)
