"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC instants, adaptive plans with skewed joins split, dates of any year readable.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes; wide projections run split up instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that someone else has started."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and trials on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tilewright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
