"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    from clickloom.registered.sql import sql

    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # Time texts carry UTC offsets and are shown in UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return fn

    return add


def load() -> None:
    from clickloom.registered import etl, files, recs, users  # noqa: F401
