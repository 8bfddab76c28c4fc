"""Picking rows by a set of ids without shuffling all texts.

Hashed ids, at most ``SLOTS`` of them and so a broadcast of bounded size, tell apart the rows that cannot be
meant. Only the others are joined exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 1 << 19
_SLOT = "sifted slot"


def _slot(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SLOTS))


def _slots(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids.select(_slot(F.col(ids.columns[0])).alias(_SLOT)).distinct())


def only(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is in the one column of ``ids``; a null key equals a null id."""
    ids = ids.toDF("sifted id")
    near = df.join(_slots(ids), _slot(F.col(key)) == F.col(_SLOT), "left_semi")
    return near.join(ids, F.col(key).eqNullSafe(F.col("sifted id")), "left_semi")


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is not in the one column of ``ids``."""
    ids = ids.toDF("sifted id")
    slots = _slots(ids)
    far = df.join(slots, _slot(F.col(key)) == F.col(_SLOT), "left_anti")
    near = df.join(slots, _slot(F.col(key)) == F.col(_SLOT), "left_semi")
    return far.unionByName(near.join(ids, F.col(key).eqNullSafe(F.col("sifted id")), "left_anti"))
