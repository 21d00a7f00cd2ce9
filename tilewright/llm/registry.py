"""Queries of this subpackage, by name, with checking SQL where there is one."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm.groups import configure as configure_batches
from tilewright.session import configure

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure_batches(configure(spark))
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
