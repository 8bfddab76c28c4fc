"""Approximate distinct counts that merge: HyperLogLog sketches kept per batch, added up without reading rows again.

A sketch has ``2 ** LOG_SIZE`` registers, so a few kilobytes whatever it has counted. Its relative standard error
is below ``1.04 / sqrt(2 ** LOG_SIZE)``; few values are counted exactly or nearly so. Nulls are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LOG_SIZE = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_SIZE / 2)


def sketch_parts(df: DataFrame, keys: list[str], columns: list[str], log_size: int = LOG_SIZE) -> DataFrame:
    """One row for each value of ``keys``: rows, and a sketch of every column (``<column>_sketch``)."""
    sketches = [F.hll_sketch_agg(F.col(c), log_size).alias(f"{c}_sketch") for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merge_parts(parts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Parts of any number of batches as parts of fewer keys; merging in steps gives the same as at once."""
    merged = [F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns]
    return parts.groupBy(*keys).agg(F.sum("rows").alias("rows"), *merged)


def estimates(parts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys``, rows and the estimated distinct values of every column."""
    return parts.select(*keys, "rows", *[F.hll_sketch_estimate(f"{c}_sketch").alias(c) for c in columns])
