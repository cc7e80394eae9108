"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(column: str, alias: str | None = None) -> Column:
    return F.col(column).cast("bigint").alias(alias or column.split(".")[-1])


def num(column: str, alias: str | None = None, digits: int = 4) -> Column:
    return F.round(F.col(column).cast("double"), digits).alias(alias or column.split(".")[-1])


def shown(column: str, alias: str | None = None) -> Column:
    """Dates and times as text."""
    return F.col(column).cast("string").alias(alias or column.split(".")[-1])
