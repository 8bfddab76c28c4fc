"""Near-duplicate documents by BagMinHash.

A text is the multiset of its five-word shingles (all its words when it has fewer). Every shingle owns one
Poisson process over (time, weight, register), seeded by its name. Weights are integers, cut into dyadic
levels (0, 1], (1, 2], (2, 4], ...; a level has a process of its own, at the rate of its width, and a shingle
that reaches only part of a level thins that process by the weight coordinate of its points. The signature
holds the earliest point of each register, so two texts agree in a register with the probability of their
weighted Jaccard similarity.

Signatures are cut into bands. Texts that share a band are compared exactly, by multiset overlap, and links
of at least ``threshold`` form classes. Equal texts are one node of this graph. First the texts of every band are
compared with one leader, so a group of near copies costs one comparison each. Then those of different classes in
a band of at most ``CROWD`` texts are compared with one another. Where larger bands still have several classes,
their texts get a longer signature with longer bands, and are again compared with the leaders of these. Texts of a
large band that are then still in different classes meet in blocks of signatures; the pairs whose signatures agree
as often as those of links do, but for four standard deviations, are compared too.

A link is passed over when its texts share no band: at a similarity of 0.8 once in 2,800 times, from 0.85 on
less than once in 100,000 times. Where all bands they share are large, they must share a longer band as well,
which fails as rarely (once in 2,800 times at 0.8), and in a block the four standard deviations pass over one
link in 30,000. Links between texts that other links bring into one class are not needed.

Null texts are alone in their class. Empty and blank texts are alike only when equal. Document ids are
taken as unique; a repeated row falls in the class of its twin. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.components import components
from clickloom.llm.sift import only, without
from clickloom.llm.texts import PIECE_BYTES, SHINGLE_WORDS, add_columns, flat, free_name, mix, pieces, shingle_names
from clickloom.operators.ordering import global_index
from clickloom.session import materialise, release

THRESHOLD = 0.8
CROWD = 16
BLOCK = 256


@dataclass(frozen=True)
class Bands:
    count: int
    rows: int

    @property
    def registers(self) -> int:
        return self.count * self.rows


# At a similarity of 0.8 a pair shares a band with a probability of 0.9996, and a longer one too.
BANDS = Bands(20, 5)
LONG_BANDS = Bands(70, 10)


def bags(offsets: np.ndarray, data: np.ndarray, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle name, count), ordered by text."""
    text, name = shingle_names(offsets, data, words)
    order = np.lexsort((name, text))
    text, name = text[order], name[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (name[1:] != name[:-1])
    at = np.flatnonzero(new)
    return text[at], name[at], np.diff(np.append(at, len(text)))


def bag_minhash(text: np.ndarray, name: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """One row of ``registers`` earliest times for each text; infinite where the text has no shingle."""
    signature = np.full(texts * registers, np.inf)
    total = np.bincount(text, count, texts)
    # Points are made up to a time by which all registers are nearly surely filled; else up to a later one.
    reach = math.log(registers) + 4
    missing = np.flatnonzero(total > 0)
    while len(missing):
        limit = np.zeros(texts)
        limit[missing] = registers * reach / total[missing]
        chosen = np.flatnonzero(limit[text] > 0)
        level = 0
        while len(chosen):
            _points(signature, registers, text[chosen], name[chosen], count[chosen], limit, level)
            chosen = chosen[count[chosen] > 1 << level]
            level += 1
        missing = missing[np.isinf(signature.reshape(texts, registers)[missing]).any(1)]
        reach *= 2
    return signature.reshape(texts, registers)


def _points(signature: np.ndarray, registers: int, text: np.ndarray, name: np.ndarray, count: np.ndarray, limit: np.ndarray, level: int) -> None:
    """Lower ``signature`` by the points of one weight level: (0, 1] for level 0, then (2^(level-1), 2^level]."""
    width = max(1, 1 << level >> 1)
    seed = mix(name ^ np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    until, time, draw = limit[text], np.zeros(len(text)), 0
    while len(seed):
        draw += 1
        random = mix(seed + np.uint64(2 * draw))
        time = time - np.log(((random >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / width
        live = time <= until
        text, seed, count, until, time = text[live], seed[live], count[live], until[live], time[live]
        if not len(seed):
            return
        place = mix(seed + np.uint64(2 * draw + 1))
        register = ((place >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        slot = text * registers + register.astype(np.int64)
        if level:
            weight = width + 1 + (place & np.uint64(width - 1)).astype(np.int64)
            inside = weight <= count
            np.minimum.at(signature, slot[inside], time[inside])
        else:
            np.minimum.at(signature, slot, time)


def band_names(signature: np.ndarray, bands: Bands) -> np.ndarray:
    """A 64-bit name for each text and band."""
    values = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands.count, bands.rows)
    names = mix(np.arange(bands.count, dtype=np.uint64) + np.uint64(bands.rows << 32))[None, :] + np.zeros((len(signature), 1), np.uint64)
    for k in range(bands.rows):
        names = mix(names ^ values[:, :, k])
    return names


def sign(df: DataFrame, text: str = "text", bands: Bands = BANDS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with ``text_key`` (null for a null text), ``bands`` (empty for a text without words) and, for long
    bands, ``registers``: the signature in eight bits a register, of which unlike ones agree once in 256 times,
    and after it the band names in 32 bits each."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        column = batch.column(text)
        known = column.is_valid().to_pylist()
        keys, lists, registers = [], [], []
        for first, offsets, data in pieces(column):
            n = len(offsets) - 1
            keys += [hashlib.sha256(data[offsets[i] : offsets[i + 1]]).digest() if known[first + i] else None for i in range(n)]
            signature = bag_minhash(*bags(offsets, data, words), n, bands.registers)
            names = band_names(signature, bands).view(np.int64)
            if bands is LONG_BANDS:
                eight = (mix(signature.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                codes = (names.view(np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.uint8)
                registers += [row.tobytes() for row in np.concatenate([eight, codes], 1)]
            some = np.isfinite(signature[:, 0])
            ends = np.concatenate([[0], np.cumsum(some * bands.count)]).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(names[some].ravel())))
        empty = pa.array([], pa.list_(pa.int64()))
        made = {"text_key": pa.array(keys, pa.binary()), "bands": pa.concat_arrays(lists) if lists else empty}
        return made | {"registers": pa.array(registers, pa.binary())}

    return add_columns(df, make, "text_key binary, bands array<bigint>" + (", registers binary" if bands is LONG_BANDS else ""))


def overlaps(a: pa.Array, b: pa.Array, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of two columns of texts, row by row."""
    size = flat(a)[0] + flat(b)[0]
    out, first = [np.zeros(0)], 0
    while first < len(a):
        last = max(first + 1, int(np.searchsorted(size, size[first] + PIECE_BYTES, "right")) - 1)
        out.append(_overlaps(a.slice(first, last - first), b.slice(first, last - first), words))
        first = last
    return np.concatenate(out)


def _overlaps(a: pa.Array, b: pa.Array, words: int) -> np.ndarray:
    parts = []
    for column in (a, b):
        offsets, data = flat(column)
        text, name, count = bags(offsets - offsets[0], data[offsets[0] : offsets[-1]], words)
        parts.append(np.stack([text.astype(np.uint64), name, count.astype(np.uint64)]))
    row, name, count = np.concatenate(parts, 1)
    order = np.lexsort((name, row))
    row, name, count = row[order].astype(np.int64), name[order], count[order].astype(np.int64)
    twin = np.flatnonzero((row[1:] == row[:-1]) & (name[1:] == name[:-1]))
    shared = np.bincount(row[twin], np.minimum(count[twin], count[twin + 1]), len(a))
    total = np.bincount(row, count, len(a)) - shared
    return np.divide(shared, total, out=np.zeros(len(a)), where=total > 0)


def verify(pairs: DataFrame, texts: DataFrame, threshold: float, words: int = SHINGLE_WORDS) -> DataFrame:
    """The pairs ``a, b`` whose texts (``id, text``) are similar enough."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"similarity": pa.array(overlaps(batch.column("text_a"), batch.column("text_b"), words)), "text_a": pa.nulls(batch.num_rows, pa.string()), "text_b": pa.nulls(batch.num_rows, pa.string())}

    return add_columns(both, make, "similarity double, text_a string, text_b string").where(F.col("similarity") >= threshold - 1e-12).select("a", "b")


def _open(members: DataFrame, leader_order: Column) -> DataFrame:
    """``members`` (``band, id, class_id``) of the bands with several classes, with the band's size and leader."""
    sizes = members.groupBy("band").agg(
        F.count("*").alias("n"), F.min(F.struct(leader_order.alias("o"), F.col("id"), F.col("class_id"))).alias("first"), F.min("class_id").alias("low"), F.max("class_id").alias("high")
    )
    several = sizes.where("low <> high").select("band", "n", F.col("first.id").alias("leader"), F.col("first.class_id").alias("leader_class"))
    return materialise(members.join(several, "band"))


def _stars(open_: DataFrame) -> DataFrame:
    """All texts with the leader of their band, but those of its class."""
    stars = open_.where("class_id <> leader_class")
    return materialise(stars.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())


def _pairs(open_: DataFrame) -> DataFrame:
    """Texts of different classes in small bands; leaders have been compared already."""
    one = open_.where((F.col("n") <= CROWD) & (F.col("id") != F.col("leader"))).select("band", F.col("id").alias("a"), "class_id")
    other = one.select("band", F.col("a").alias("b"), F.col("class_id").alias("class_b"))
    return materialise(one.join(other, "band").where("a < b and class_id <> class_b").select("a", "b").distinct())


def _alike(open_: DataFrame, registers: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different classes in large bands whose signatures agree nearly as often as the threshold asks.

    Signatures come in blocks of about ``BLOCK`` texts. A class of more texts than that has blocks of its own,
    which need not meet each other. A pair is given by the first of the bands that its texts share.
    """
    crowd = open_.where(F.col("n") > CROWD).select("band", "id", "class_id")
    codes = 4 * LONG_BANDS.count
    sizes = crowd.groupBy("band", "class_id").agg(F.count("*").alias("n")).withColumn("pool", F.when(F.col("n") > BLOCK, F.col("class_id")))
    pools = sizes.groupBy(F.col("band").alias("pool_band"), F.col("pool").alias("same_pool")).agg(F.sum("n").alias("pool_n"))
    pooled = sizes.join(pools, (F.col("band") == F.col("pool_band")) & F.col("pool").eqNullSafe(F.col("same_pool")))
    pooled = pooled.select("band", "class_id", "pool", "pool_n")
    chunk = F.pmod(F.xxhash64("band", "id"), F.ceil(F.col("pool_n") / BLOCK))
    rows = crowd.join(pooled, ["band", "class_id"]).join(registers, "id").withColumn("chunk", chunk)
    blocks = materialise(rows.groupBy("band", "pool", "chunk").agg(F.collect_list(F.struct("id", "class_id", "registers")).alias("texts")))
    name = F.struct(F.coalesce("pool", F.lit(-1)).alias("pool"), F.col("chunk"))
    left = blocks.select("band", name.alias("x"), F.col("texts").alias("left"))
    right = blocks.select("band", name.alias("y"), F.col("texts").alias("right"))
    meet = left.join(right, "band").where((F.col("x") <= F.col("y")) & ((F.col("x.pool") != F.col("y.pool")) | (F.col("x.pool") == -1)))
    least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / LONG_BANDS.registers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                band = np.uint32(np.uint64(batch.column("band")[row].as_py() % (1 << 64)) >> np.uint64(32))
                sides = []
                for side in ("left", "right"):
                    texts = batch.column(side)[row].values
                    matrix = np.frombuffer(b"".join(texts.field("registers").to_pylist()), np.uint8).reshape(len(texts), -1)
                    sides.append((texts.field("id").to_numpy(zero_copy_only=False), texts.field("class_id").to_numpy(zero_copy_only=False), matrix))
                (ids, classes, own), (ids2, classes2, other) = sides
                found = [np.zeros((2, 0), np.int64)]
                for i in range(len(ids)):
                    near = np.flatnonzero((classes2 != classes[i]) & ((other[:, :-codes] == own[i, :-codes]).mean(1) >= least))
                    if len(near):
                        names, names2 = np.ascontiguousarray(own[i, -codes:]).view(np.uint32), np.ascontiguousarray(other[near, -codes:]).view(np.uint32)
                        near = near[names[(names2 == names).argmax(1)] == band]
                    found.append(np.stack([np.minimum(ids[i], ids2[near]), np.maximum(ids[i], ids2[near])]))
                a, b = np.unique(np.concatenate(found, 1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return materialise(meet.select("band", "left", "right").mapInArrow(run, "a bigint, b bigint").distinct())


def _classed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``members`` with their classes so far."""
    return materialise(members.drop("class_id").join(classes, "id", "left").withColumn("class_id", F.coalesce("class_id", "id")))


def _still_open(open_: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of bands that have several of the present classes, with these."""
    settled = _classed(open_.select("band", "id", "n", "leader"), classes)
    several = settled.groupBy("band").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low <> high").select("band")
    return materialise(settled.join(several, "band"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: ``doc_id`` and ``class_id``, the smallest id among its near duplicates."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = materialise(sign(docs, words=words).drop("text"))
    # Equal texts meet here; each map task sends one row of them.
    nodes = materialise(signed.where("text_key is not null").groupBy("text_key").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")))
    members = nodes.where("id is not null").select(F.explode("bands").alias("band"), "id", F.col("id").alias("class_id"))

    def compared(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        """The classes after the links among ``pairs`` have joined those known."""
        links = materialise(verify(pairs, texts_of(docs, pairs), threshold, words))
        release(docs.sparkSession)
        return components(links if known is None else links.unionByName(known.toDF("a", "b")))

    order = F.xxhash64("id")
    open_ = _open(members, order)
    classes = compared(_stars(open_), None)
    # Sizes and leaders stay those of all texts of the band.
    open_ = _still_open(open_, classes)
    classes = compared(_pairs(open_), classes)

    # Bands of many texts that did not come into one class.
    crowded = _still_open(open_.where(F.col("n") > CROWD), classes)
    left = materialise(crowded.select(F.col("id").alias("a"), F.col("id").alias("b")).distinct())
    if not left.isEmpty():
        again = materialise(sign(texts_of(docs, left), bands=LONG_BANDS, words=words).drop("text"))
        longer = again.select(F.explode("bands").alias("band"), "id")
        order = F.xxhash64("band", "id")
        open_ = _open(_classed(longer, classes), order)
        classes = compared(_stars(open_), classes)
        open_ = _still_open(open_, classes)
        pairs = _pairs(open_).unionByName(_alike(open_, again.select("id", "registers"), threshold))
        classes = compared(materialise(pairs.distinct()), classes)

    found = nodes.select("text_key", "id").join(classes, "id", "left").select("text_key", F.coalesce("class_id", "id").alias("class_id"))
    return signed.select("doc_id", "text_key").join(found, "text_key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id, text`` of the documents in ``pairs``."""
    ids = materialise(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    # A repeated row must not double the pairs.
    return materialise(only(docs.select(F.col("doc_id").alias("id"), "text"), "id", ids).groupBy("id").agg(F.max("text").alias("text")))


def _own_keys(docs: DataFrame, doc_id: str, text: str, key: str) -> DataFrame:
    """``docs`` with ``key``, a bigint that no two different pairs of an id and a text share.

    An id that names one text is its own key. Rows without an id, or whose id names several texts, get numbers
    that no id has, above the largest or below the smallest.
    """
    digest = free_name(docs, "text_digest")
    named = docs.withColumn(digest, F.md5(F.encode(F.concat(F.lit("."), F.coalesce(text, F.lit(""))), "UTF-8")))
    named = named.withColumn(digest, F.when(F.col(text).isNull(), "-").otherwise(F.col(digest)))
    sizes = named.groupBy(doc_id).agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    shared = materialise(sizes.where(f"`{doc_id}` is null or low <> high").select(doc_id))
    own = docs.withColumn(key, F.col(doc_id).cast("bigint"))
    if shared.isEmpty():
        return own
    rows = materialise(only(named, doc_id, shared))
    pairs = rows.select(F.col(doc_id).alias("shared_id"), F.col(digest).alias("shared_digest")).distinct()
    numbers = materialise(global_index(pairs, [F.col("shared_id"), F.col("shared_digest")], "number", 1))
    n = numbers.count()
    ends = docs.agg(F.min(F.col(doc_id).cast("bigint")).alias("low"), F.max(F.col(doc_id).cast("bigint")).alias("high")).first()
    if (ends["high"] or 0) + n < 1 << 63:
        start = ends["high"] or 0
    elif ends["low"] - n >= -(1 << 63):
        start = ends["low"] - n - 1
    else:
        raise ValueError(f"{n} rows with shared or missing ids find no free number beside ids from {ends['low']} to {ends['high']}")
    same = F.col(doc_id).eqNullSafe(F.col("shared_id")) & (F.col(digest) == F.col("shared_digest"))
    keyed = rows.join(numbers, same).withColumn(key, F.col("number") + F.lit(start)).select(*own.columns)
    return without(own, doc_id, shared).unionByName(materialise(keyed))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id; of repeated rows, one stays.

    Rows are judged by their id and text, so different texts that share an id, or have none, are documents of their
    own. Such a row gives way to one of its class with an id of its own, but where no numbers above the ids are free."""
    key = free_name(docs, "row_key")
    docs_ = _own_keys(docs, doc_id, text, key)
    found = materialise(near_duplicates(docs_, threshold, key, text, words))
    copies = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("class_id").alias("class_id"))
    doubtful = materialise(copies.where("n > 1 or class_id <> doc_id"))
    sure = without(docs_, key, doubtful.select("doc_id"))
    again = doubtful.where("class_id = doc_id").select("doc_id")
    return sure.unionByName(only(docs_, key, again).dropDuplicates([key])).drop(key)
