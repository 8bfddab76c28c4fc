"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

An item is found in a document when at least ``threshold`` of the item's distinct five-word shingles occur in
it, however long the document is. Items are partitioned by their number of shingles, in powers of two. A
class whose largest size is ``u`` gives each of its items a MinHash signature of the ``u - ceil(threshold * u) + 1``
shingles with the smallest hashes. An item that a document contains can lack fewer shingles than that, so at
least one signature shingle occurs in the document: the search misses nothing. Candidates are then verified by
counting the item's shingles, as strings, in the whole document.

Words are runs of characters other than ASCII white space. Items of fewer than five words have no shingle and
are never found; null and empty texts contain nothing. Rows with equal ids count as one document or item that
holds the shingles of all of them. Only the id and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.sift import only
from clickloom.session import materialise

WORDS = 5
THRESHOLD = 0.8
# Signatures and item shingles are broadcast up to this many rows (16 bytes each), else joined by shuffle.
BROADCAST_ROWS = 500_000
_BLANK = "[ \\t-\\r]+"


def words(text: str) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BLANK), lambda w: w != "")


def shingles(words_: str, combine) -> Column:
    """``combine`` of every run of five words of the array column; an empty array for fewer words."""
    n = F.size(words_)
    at = F.when(n >= WORDS, F.sequence(F.lit(0), n - WORDS)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: combine(*[F.get(F.col(words_), i + k) for k in range(WORDS)]))


def hashed(*w: Column) -> Column:
    # The separator keeps the hash one of the joined string, whatever the words.
    return F.xxhash64(*[x for word in w for x in (word, F.lit(" "))])


def joined(*w: Column) -> Column:
    return F.concat_ws(" ", *w)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast when its counted rows are few; a larger one is joined as Spark sees fit."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def find_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """Pairs ``doc_id, item_id, n_shingles, n_found, containment`` with a containment of at least ``threshold``."""
    listed = items.select(F.col(item_id).alias("item_id"), words(text).alias("words"))
    grams = materialise(listed.select("item_id", F.explode(shingles("words", joined)).alias("gram")).distinct())
    sizes = grams.groupBy(F.col("item_id").alias("sized_id")).agg(F.count("*").alias("n_shingles"))
    same_item = F.col("item_id").eqNullSafe(F.col("sized_id"))

    # 2^(c+1) - 1 is the largest size of class c; an item may lack `spare` shingles at most.
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_shingles")) + 1) - 1
    spare = largest - F.ceil(largest * threshold - 1e-9)
    order = F.struct(F.xxhash64("gram", F.lit("signature")), F.col("gram"))
    signatures = materialise(
        grams.join(sizes, same_item).select("item_id", "gram", (spare + 1).cast("int").alias("k"))
        .groupBy("item_id", "k").agg(F.sort_array(F.collect_list(F.struct(order.alias("order"), F.col("gram")))).alias("all"))
        .select("item_id", F.explode(F.slice("all", F.lit(1), F.col("k"))).alias("s"))
        .select("item_id", F.xxhash64(*_split_words("s.gram")).alias("h"))
        .distinct()
    )

    read = docs.select(F.col(doc_id).alias("doc_id"), words(text).alias("words"))
    found = read.select("doc_id", F.explode(F.array_distinct(shingles("words", hashed))).alias("h"))
    candidates = materialise(found.join(bounded(signatures, signatures.count()), "h").select("doc_id", "item_id").distinct())

    chosen = candidates.select("doc_id").distinct()
    whole = only(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", chosen).select("doc_id", words("text").alias("words"))
    held = whole.select("doc_id", F.explode(F.array_distinct(shingles("words", joined))).alias("gram"))
    hits = held.join(bounded(grams, grams.count()), "gram").groupBy("doc_id", "item_id").agg(F.count_distinct("gram").alias("n_found"))
    return (
        hits.join(sizes, same_item)
        .where(F.col("n_found") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))
        .select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))
    )


def _split_words(gram: str) -> list[Column]:
    """The arguments by which ``hashed`` would hash the words of a joined shingle."""
    parts = F.split(F.col(gram), " ")
    return [x for k in range(WORDS) for x in (F.get(parts, F.lit(k)), F.lit(" "))]
