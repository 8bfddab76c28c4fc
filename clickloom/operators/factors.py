"""Latent item factors: randomised truncated SVD of the item x user weight matrix.

The matrix stays in long form (``user_id, article_id, weight``). Each half step multiplies it by a block of
vectors. The pairs are dealt into blocks twice, once by article and once by user, packed into arrays of positions and
weights, and then stay where they lie: a half step sends each vector, as bytes, to its place in the blocks that hold
pairs of its id, some columns at a time, so that what is on the disk at once stays in proportion to the pairs. Only width x width Gram matrices (a few thousand numbers) reach
the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.session import discard, materialise, work_path, write_scratch

COMPONENTS = 50
OVERSAMPLES = 10
POWER_STEPS = 5
# Few blocks: a vector goes once to each block that needs it.
PAIRS_PER_BLOCK = 1 << 21
SLICE = 1 << 13
# Vectors on their way to the blocks: bytes for each pair, and at least so many in all.
ROUTED_PER_PAIR, ROUTED_LEAST = 64, 1 << 30


def component_count(items: int, users: int, wanted: int = COMPONENTS) -> int:
    return max(2, min(wanted, min(items, users) - 1))


def _names(width: int) -> list[str]:
    return [f"f{j}" for j in range(width)]


def _rotate(df: DataFrame, key: str, turn: np.ndarray) -> DataFrame:
    """Multiply every row vector by ``turn``."""
    old, new = _names(turn.shape[0]), _names(turn.shape[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame(pdf[old].to_numpy() @ turn, columns=new)
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return df.mapInPandas(run, f"{key} string, " + ", ".join(f"{n} double" for n in new))


def _gram(df: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products of the row vectors, added up by Spark."""
    names = _names(width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for pdf in batches:
            block = pdf[names].to_numpy()
            total += block.T @ block
        yield pd.DataFrame({"at": np.arange(width * width), "v": total.ravel()})

    cells = df.select(*names).mapInPandas(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width * width)
    for c in cells:
        out[c["at"]] = c["v"]
    return out.reshape(width, width)


def _whiten(gram: np.ndarray) -> np.ndarray:
    """Matrix that makes columns with this Gram matrix orthonormal; null directions become zero."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > values.max() * 1e-13
    return vectors * np.where(keep, 1.0 / np.sqrt(np.where(keep, values, 1.0)), 0.0)


@dataclass(frozen=True)
class Layout:
    """The pairs in blocks and the blocks, and places there, that each left id is needed in (``routes``: id, ``to``).

    ``packs`` has one row for each block: the ids ``left`` and ``right``, and for all pairs, by right id, the place of
    the left id (``at``) and ``weight``, up to ``ends``. They lie in the work folder as a table bucketed by block, so a
    join by block does not move them. ``blocks`` shows which right ids are in a block. So many ``columns`` of the
    vectors are sent at a time."""

    packs: DataFrame
    blocks: DataFrame
    routes: DataFrame
    left: str
    right: str
    split: bool
    table: str
    folders: tuple[str, str]
    columns: int


_PACK = "block int, left array<string>, right array<string>, ends binary, at binary, weight binary"


def _pack(pairs: pa.Table) -> pa.Table:
    """One block as a row of lists and arrays."""
    lefts = pairs.column("left").combine_chunks().dictionary_encode()
    rights = pairs.column("right").combine_chunks().dictionary_encode()
    codes = rights.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    row = {
        "block": pairs.column("block")[:1].cast(pa.int32()),
        "left": pa.array([lefts.dictionary], pa.list_(pa.string())),
        "right": pa.array([rights.dictionary], pa.list_(pa.string())),
        "ends": pa.array([np.cumsum(np.bincount(codes)).astype(np.int64).tobytes()], pa.binary()),
        "at": pa.array([lefts.indices.to_numpy()[order].astype(np.int32).tobytes()], pa.binary()),
        "weight": pa.array([pairs.column("weight").to_numpy()[order].tobytes()], pa.binary()),
    }
    return pa.table(row)


def lay_out(pairs: DataFrame, left: str, right: str, total: int, pairs_per_block: int = PAIRS_PER_BLOCK) -> Layout:
    """Deal ``pairs`` once into blocks of about ``pairs_per_block``, the pairs of one ``right`` id together.

    An id with more pairs than a block is salted by the hash of the left id, over as many blocks as it fills.
    """
    spark = pairs.sparkSession
    parts = max(-(-total // pairs_per_block), spark.sparkContext.defaultParallelism)
    counts = pairs.groupBy(right).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > pairs_per_block)
    hot = materialise(counts.select(right, F.ceil(F.col("n") / pairs_per_block).alias("salts")))
    split = not hot.isEmpty()
    salt = F.lit(0).cast("bigint")
    if split:
        pairs = pairs.join(hot, right, "left")
        salt = F.pmod(F.xxhash64(left), F.coalesce("salts", F.lit(1).cast("bigint")))
    block = F.pmod(F.xxhash64(F.col(right), salt), F.lit(parts)).cast("int").alias("block")
    dealt = pairs.select(block, F.col(left).alias("left"), F.col(right).alias("right"), "weight")
    name = f"pairs_by_{right}_{uuid.uuid4().hex}"
    buckets = min(parts, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    folder = work_path(spark, name)
    writer = dealt.repartition(buckets, "block").groupBy("block").applyInArrow(_pack, _PACK).write.format("parquet").option("path", folder)
    writer.bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
    packs = spark.table(name)
    # An id has one row, with a place for each block that needs it: as many as there are blocks at most.
    places = packs.select(F.col("block").alias("to_block"), F.posexplode("left").alias("place", left))
    routes, routed = write_scratch(places.groupBy(left).agg(F.collect_list(F.struct("to_block", "place")).alias("to")), "routes")
    sent = routes.agg(F.sum(F.size("to"))).first()[0] or 0
    columns = (max(ROUTED_LEAST, ROUTED_PER_PAIR * total) // max(sent, 1) - 24) // 8
    blocks = packs.select("block", F.explode("right").alias("right"))
    return Layout(packs, blocks, routes, left, right, split, name, (folder, routed), max(1, columns))


def forget(layout: Layout) -> None:
    """Remove the table of a layout and its files."""
    spark = layout.blocks.sparkSession
    spark.sql(f"DROP TABLE {layout.table}")
    discard(spark, *layout.folders)


def multiply(layout: Layout, vectors: DataFrame, width: int) -> tuple[DataFrame, list[str]]:
    """``product``, written, and the folders that it lies in: as many columns at a time as the layout says."""
    spark, made, folders = vectors.sparkSession, [], []
    for first in range(0, width, layout.columns):
        names = _names(width)[first : first + layout.columns]
        part = product(layout, vectors.select(layout.left, *[F.col(n).alias(m) for n, m in zip(names, _names(len(names)))]), len(names))
        part = part.select(layout.right, *[F.col(m).alias(n) for n, m in zip(names, _names(len(names)))])
        rows, folder = write_scratch(part, "product", plain=True)
        made.append(rows)
        folders.append(folder)
        if len(names) < width:
            discard(spark)
    if len(made) == 1:
        return made[0], folders
    whole, folder = write_scratch(reduce(lambda a, b: a.join(b, layout.right), made), "vectors", plain=True)
    discard(spark, *folders)
    return whole, [folder]


def _as_bytes(names: list[str]):
    """mapInArrow body: the id and the vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * rows.itemsize * len(names)
            made = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows)])
            yield pa.RecordBatch.from_arrays([batch.column(0), made], [batch.schema.names[0], "vector"])

    return run


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [np.zeros((0, width))]
    for chunk in column.chunks:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float64).reshape(-1, width))
    return np.concatenate(parts)


def product(layout: Layout, vectors: DataFrame, width: int) -> DataFrame:
    """``right``-keyed block = matrix (or its transpose) times the ``left``-keyed block ``vectors``.

    Every vector goes once to each block that has pairs of its id. The pairs stay where they lie.
    """
    names, right = _names(width), layout.right
    packed = vectors.select(layout.left, *names).mapInArrow(_as_bytes(names), f"{layout.left} string, vector binary")
    routed = packed.join(layout.routes, layout.left).select("vector", F.inline("to"))

    def run(pairs: pa.Table, known: pa.Table) -> pa.Table:
        if not pairs.num_rows or not known.num_rows:
            return pa.table([pa.array([], pa.string()), *(pa.array([], pa.float64()) for _ in names)], names=[right, *names])
        ends, at, weight = (np.frombuffer(pairs.column(c)[0].as_buffer(), kind) for c, kind in (("ends", np.int64), ("at", np.int32), ("weight", np.float64)))
        place = known.column("place").to_numpy()
        places = int(max(place.max(), at.max())) + 1
        matrix, here = np.zeros((places, width)), np.zeros(places, bool)
        matrix[place], here[place] = _vectors(known.column("vector"), width), True
        out, first = np.zeros((len(ends), width)), 0
        # Some thousand pairs at a time; the ids of one slice are consecutive.
        while first < len(ends):
            begin = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, begin + SLICE, "right")))
            rows = slice(begin, ends[last - 1])
            starts = np.concatenate([[0], ends[first : last - 1] - begin])
            out[first:last] = np.add.reduceat(matrix[at[rows]] * weight[rows, None], starts, axis=0)
            first = last
        made = pa.table([pairs.column("right").combine_chunks().flatten(), *(pa.array(out[:, j]) for j in range(width))], names=[right, *names])
        # An id none of whose vectors came has no row.
        return made if here.all() else made.filter(pa.array(np.add.reduceat(here[at], np.concatenate([[0], ends[:-1]])) > 0))

    schema = f"{right} string, " + ", ".join(f"{n} double" for n in names)
    made = layout.packs.select("block", "right", "ends", "at", "weight").groupBy("block").cogroup(routed.groupBy("to_block")).applyInArrow(run, schema)
    return made.groupBy(right).agg(*[F.sum(n).alias(n) for n in names]) if layout.split else made


def item_factors(
    pairs: DataFrame, components: int = COMPONENTS, power_steps: int = POWER_STEPS, seed: int = 42, pairs_per_block: int = PAIRS_PER_BLOCK
) -> DataFrame:
    """``article_id, embedding array<double>``: left singular vectors times singular values. Pairs with a null in
    any column do not count."""
    spark = pairs.sparkSession
    pairs, paired = write_scratch(
        pairs.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("article_id").cast("string").alias("article_id"),
            F.col("weight").cast("double").alias("weight"),
        ).dropna(),
        "pairs",
    )
    discard(spark)
    shape = pairs.agg(F.count_distinct("article_id").alias("i"), F.count_distinct("user_id").alias("u"), F.count(F.lit(1)).alias("n")).first()
    n = component_count(shape["i"], shape["u"], components)
    width = min(n + OVERSAMPLES, min(shape["i"], shape["u"]))
    width = max(width, 1)
    n = min(n, width)

    # Random signs from the bits of seeded hashes of the user, so the start block needs no join and no storage.
    h = [F.xxhash64(F.lit(seed + i), F.col("user_id")) for i in range(-(-width // 64))]
    signs = [F.when(F.shiftright(h[j // 64], j % 64).bitwiseAND(F.lit(1)) == 1, F.col("weight")).otherwise(-F.col("weight")) for j in range(width)]
    items, folder = write_scratch(pairs.groupBy("article_id").agg(*[F.sum(s).alias(f"f{j}") for j, s in enumerate(signs)]), "start", plain=True)
    mine = [folder]
    by_user = lay_out(pairs, "article_id", "user_id", shape["n"], pairs_per_block)
    by_item = lay_out(pairs, "user_id", "article_id", shape["n"], pairs_per_block)
    discard(spark, paired)
    for _ in range(power_steps):
        basis = _rotate(items, "article_id", _whiten(_gram(items, width)))
        users, theirs = multiply(by_user, basis, width)
        discard(spark, *mine)
        items, mine = multiply(by_item, users, width)
        discard(spark, *theirs)
    # The rows returned are made from the last items, which stay.
    basis = _rotate(items, "article_id", _whiten(_gram(items, width)))
    forget(by_item)
    users, theirs = multiply(by_user, basis, width)
    values, vectors = np.linalg.eigh(_gram(users, width))
    forget(by_user)
    discard(spark, *theirs)
    top = np.argsort(values)[::-1][:n]
    turn = vectors[:, top] * np.sqrt(np.maximum(values[top], 0.0))
    wide = _rotate(basis, "article_id", turn)
    return wide.select("article_id", F.array(*_names(n)).alias("embedding"))
