"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.session import materialise, release, ship

LINKS_PER_TASK = 1 << 19


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id of the links and the smallest id it is connected to."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        # The labels of both ends, which are ids too, learn of the smaller one.
        for end in (label[x], label[y], x, y):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def _contract(links: DataFrame, parts: int) -> DataFrame:
    """Each task turns its links into one link from every id to the smallest that it knows to be connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [np.stack([b.column("id").to_numpy(zero_copy_only=False), b.column("other").to_numpy(zero_copy_only=False)]) for b in batches if b.num_rows]
        if sides:
            ids, labels = least_labels(*np.concatenate(sides, 1))
            for first in range(0, len(ids), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(ids[first : first + (1 << 16)]), pa.array(labels[first : first + (1 << 16)])], names=["id", "other"])

    ship(links.sparkSession)
    return materialise(links.coalesce(parts).mapInArrow(run, "id bigint, other bigint"))


def components(links: DataFrame, a: str = "a", b: str = "b", links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """``id, class_id`` for every linked id; the class is the smallest id that links lead to.

    Tasks first contract the links they hold, ``links_per_task`` at most by count, and again what is left, in
    fewer tasks, as long as that shrinks it. What no single task can hold goes on in rounds of joins. A table of
    classes is a table of links, so known classes go on with new links by their union. Links are never collected.
    """
    left = materialise(links.select(F.col(a).cast("bigint").alias("id"), F.col(b).cast("bigint").alias("other")).where("id <> other"))
    n = left.count()
    if not n:
        return left.select("id", F.col("other").alias("class_id"))
    while True:
        parts = -(-n // links_per_task)
        left = _contract(left, parts)
        if parts == 1:
            return left.select("id", F.col("other").alias("class_id"))
        before, n = n, left.count()
        if 4 * n > 3 * before:
            return _join_rounds(left)


def _join_rounds(links: DataFrame) -> DataFrame:
    """Each round takes the smallest label among the neighbours and then the label of that label, so chains
    shorten by more than half. Labels are checkpointed every round. Minimum and join work on hot ids without
    gathering their neighbours in one place."""
    both = materialise(
        links.unionByName(links.select(F.col("other").alias("id"), F.col("id").alias("other"))).where("id <> other").distinct()
    )
    labels = materialise(both.groupBy("id").agg(F.min(F.least("id", "other")).alias("class_id")))
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), F.col("class_id").alias("offered")), "other")
        best = near.groupBy("id").agg(F.min("offered").alias("offered"))
        step = labels.join(best, "id").select("id", F.col("class_id").alias("before"), F.least("class_id", "offered").alias("class_id"))
        further = labels.select(F.col("id").alias("class_id"), F.col("class_id").alias("root"))
        labels_ = materialise(step.join(further, "class_id").select("id", "before", F.least("class_id", "root").alias("class_id")))
        labels = labels_.select("id", "class_id")
        if labels_.where("class_id <> before").isEmpty():
            return labels
        release(labels.sparkSession)
