"""A Merkle manifest of a table: a leaf for each row, a tree for each source, and a tree over the sources.

Where a leaf stands in its source's tree is not found by sorting the rows but by counting bits. For each source
a bitmap holds the ids it has, as words of 64 ids of which only those with a bit exist; map tasks merge what they
have of a word before it is shuffled. A directory of popcounts over the words, then over groups of 1,024 words
and so on, gives the rows before each word, and the bits below the id's own in its word give the rest. No group
of the directory has more than 1,024 entries, whatever the source's share of the rows.

Leaves then fall into slots: ``SLOTS`` of them, a power of three, make the keyed array of one block, and a block
is folded to its root in one expression, six levels at a time. The paths come back the same way, from the tree
over the sources down to the leaves.

Defined cases. Rows of one source and one id follow one another by leaf digest; their places come from a second
count over the first digits of the digest, so an id with a third of all rows is no group of its own. Equal rows
are equal leaves, each with a place. A null id comes before all ids, a null source before all sources, and an
empty source after the null one. Null values are ``-``. An empty table has no rows and no root. Columns besides
the five named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.operators.ordering import global_index
from clickloom.session import materialise

FAN = 3
LEVELS = 6
SLOTS = FAN**LEVELS
_GROUP = 10  # bits: words, or groups of words, that share one entry of the directory above
_NO_ID = -(1 << 58)  # the word of rows without an id, below that of every id
_DIGITS = 4


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def leaf_rows(docs: DataFrame) -> DataFrame:
    """``src, doc_id, leaf, tampered``: the digest of each row, and that of the row whose text has lost its line
    ends, for every other row by the checksum of the id (else null). ``src`` sorts as the source does, null first."""
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    broken = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("src"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest(*parts, F.col("text")).alias("leaf"),
        F.when(broken, leaf_digest(*parts, F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"),
    )


def _word(df: DataFrame) -> DataFrame:
    return df.withColumn("word", F.coalesce(F.shiftright("doc_id", 6), F.lit(_NO_ID))).withColumn("bit", F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int"))


def bitmaps(rows: DataFrame) -> DataFrame:
    """``src, word, bits, n``: the ids of a source in words of 64, and how many rows they are."""
    one = F.expr("shiftleft(1L, bit)")
    return _word(rows.select("src", "doc_id")).groupBy("src", "word").agg(F.bit_or(one).alias("bits"), F.count("*").alias("n"))


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``before``, the rows of the source in lower words, and ``total``, all its rows."""
    levels = [words.select("src", F.col("word").alias("node"), "n")]
    while True:
        span = levels[-1].agg((F.max("node") - F.min("node")).alias("span")).first()["span"]
        if (span or 0) < 1 << _GROUP:
            break
        up = levels[-1].groupBy("src", F.shiftright("node", _GROUP).alias("node")).agg(F.sum("n").alias("n"))
        levels.append(materialise(up))
    # Within the whole source at the top, within one parent below.
    below = Window.partitionBy("src").orderBy("node")
    ahead = F.coalesce(F.sum("n").over(below.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = levels[-1].select("src", "node", ahead.alias("before"), F.sum("n").over(Window.partitionBy("src")).alias("total"))
    for level in levels[-2::-1]:
        inside = Window.partitionBy("src", "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        placed = level.withColumn("parent", F.shiftright("node", _GROUP)).withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        known = placed.join(known.withColumnRenamed("node", "parent"), ["src", "parent"]).select("src", "node", (F.col("before") + F.col("ahead")).alias("before"), "total")
    return words.join(known.withColumnRenamed("node", "word"), ["src", "word"])


def _repeats(rows: DataFrame, words: DataFrame) -> DataFrame | None:
    """``src, doc_id, rows``: the ids that several rows of a source share; None if there are none."""
    full = materialise(words.where(F.col("n") > F.bit_count("bits")).select("src", "word"))
    if full.isEmpty():
        return None
    near = _word(rows.select("src", "doc_id")).join(full, ["src", "word"], "left_semi")
    return materialise(near.groupBy("src", "word", "bit", "doc_id").agg(F.count("*").alias("rows")).where("rows > 1"))


def _same_id(other: DataFrame) -> tuple[DataFrame, Column]:
    """``other`` under names of its own, and the condition that a row ``r`` has its source and id."""
    return other.withColumnsRenamed({"src": "same_src", "doc_id": "same_id"}), (F.col("r.src") == F.col("same_src")) & F.col("r.doc_id").eqNullSafe(F.col("same_id"))


def _spread_repeats(rows: DataFrame, repeats: DataFrame) -> DataFrame:
    """The rows of repeated ids, with their place among the rows of the id (``step``)."""
    own = rows.alias("r").join(*_same_id(repeats.select("src", "doc_id")), "left_semi")
    equal = own.groupBy("src", "doc_id", "leaf").agg(F.max("tampered").alias("tampered"), F.count("*").alias("copies"))
    equal = materialise(equal.withColumn("digits", F.substring("leaf", 1, _DIGITS)))
    counts = equal.groupBy("src", "doc_id", "digits").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("src", "doc_id").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    counts, same = _same_id(counts.select("src", "doc_id", F.col("digits").alias("first_digits"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("src", "doc_id", "digits").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    placed = equal.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("r")
    first = F.col("ahead") + F.col("inside")
    placed = placed.join(counts, same & (F.col("r.digits") == F.col("first_digits")))
    return placed.select("r.src", "r.doc_id", "r.leaf", "r.tampered", F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("step"))


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` (``src, doc_id, leaf, tampered``) with ``pos``, the place in the source, and ``count``, its rows."""
    words = materialise(bitmaps(rows))
    repeats = _repeats(rows, words)
    ranks = directory(words)
    here = rows.withColumn("step", F.lit(0).cast("bigint"))
    if repeats is None:
        extra = F.lit(0)
    else:
        single = here.alias("r").join(*_same_id(repeats.select("src", "doc_id")), "left_anti")
        here = single.unionByName(_spread_repeats(rows, repeats))
        # At most 64 entries: the repeated ids of one word.
        more = repeats.groupBy("src", "word").agg(F.collect_list(F.struct("bit", (F.col("rows") - 1).alias("more"))).alias("extra"))
        ranks = ranks.join(more, ["src", "word"], "left")
        extra = F.expr("coalesce(aggregate(filter(extra, x -> x.bit < bit), 0L, (a, x) -> a + x.more), 0L)")
    lower = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    found = _word(here).join(ranks.drop("n"), ["src", "word"])
    return found.select("src", (F.col("before") + lower + extra + F.col("step")).alias("pos"), "leaf", F.col("total").alias("count"), "doc_id", "tampered")


# A block's nodes level by level, from its leaves to its root: every level joins the digests of three slots.
_TREE = f"""aggregate(slice(array({", ".join(map(str, range(1, LEVELS + 1)))}), 1, levels), array(transform(slots, x -> x.leaf)),
  (tree, l) -> concat(tree, array(transform(sequence(0, cast((size(element_at(tree, -1)) + {FAN - 1}) div {FAN} as int) - 1),
    i -> sha2(array_join(slice(element_at(tree, -1), {FAN} * i + 1, {FAN}), ''), 256)))))"""
_AT = f"cast(j div element_at(array({', '.join(str(FAN**k) for k in range(LEVELS))}), l + 1) as int)"
# For each level the digests of the run that stand before and after the leaf's own node.
_PATH = f"""transform(slice(tree, 1, levels), (nodes, l) -> struct(
  array_join(slice(nodes, {_AT} - {_AT} % {FAN} + 1, {_AT} % {FAN}), '') AS before,
  array_join(slice(nodes, {_AT} + 2, {FAN - 1} - {_AT} % {FAN}), '') AS after))"""


def fold(nodes: DataFrame, items: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``src, pos, leaf, count`` and the columns ``items``: the blocks of every round, leaves first, and
    the roots ``src, root``."""
    rounds, roots, here = [], None, nodes
    while True:
        slot = F.struct("pos", "leaf", *items)
        levels = F.expr(f"least({LEVELS}, cast(ceil(round(ln(max(count)) / ln({FAN}), 9)) as int))")
        grouped = here.groupBy("src", F.expr(f"pos div {SLOTS}").alias("block")).agg(F.array_sort(F.collect_list(slot)).alias("slots"), F.max("count").alias("count"), levels.alias("levels"))
        blocks = materialise(grouped.withColumn("tree", F.expr(_TREE)).withColumn("leaf", F.expr("element_at(element_at(tree, -1), 1)")))
        rounds.append(blocks)
        above = blocks.select("src", F.col("block").alias("pos"), "leaf", F.expr(f"(count + {SLOTS - 1}) div {SLOTS}").alias("count"))
        done = above.where("count = 1").select("src", F.col("leaf").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        here, items = above.where("count > 1"), []
        if here.isEmpty():
            return rounds, roots


def paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The items of every leaf with ``path``, its siblings level by level up to and through ``tops`` (``src, path``
    and further columns)."""
    held = None
    further = [c for c in tops.columns if c not in ("src", "path")]
    for at in range(len(rounds) - 1, -1, -1):
        blocks = rounds[at]
        ends = blocks.where(f"count <= {SLOTS}").join(tops, "src")
        if held is not None:
            ends = ends.unionByName(blocks.where(f"count > {SLOTS}").join(held.withColumnRenamed("pos", "block"), ["src", "block"]))
        each = f"explode(transform(slots, (x, j) -> struct(x AS item, concat({_PATH}, path) AS path))) AS slot"
        names = [c for c in blocks.schema["slots"].dataType.elementType.names]
        held = ends.select("src", *further, F.expr(each)).select("src", *further, *[F.col(f"slot.item.{c}").alias(c) for c in names], "slot.path")
        if at:
            held = held.drop("leaf")
    return held


def manifest(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (``doc_id, source, lang, n_chars, text``): ``doc_id, source, pos, leaf, subroot, root,
    proof_sha256, folded_root, verified``.

    ``proof_sha256`` digests all siblings on the way from the leaf to the root; ``folded_root`` is what the leaf of
    the row as tampered with, or else its own, gives with them, and ``verified`` tells whether that is the root.
    """
    rows = materialise(leaf_rows(docs))
    rounds, roots = fold(coordinates(rows), ["doc_id", "tampered"])
    subroots = materialise(roots)
    ordered = materialise(global_index(subroots, [F.col("src")], "pos"))
    sources = ordered.count()
    tops, top = fold(ordered.select(F.lit("").alias("src"), "pos", F.col("root").alias("leaf"), F.lit(sources).cast("bigint").alias("count"), F.col("src").alias("name")), ["name"])
    root = top.first()
    start = docs.sparkSession.range(1).select(F.lit("").alias("src"), F.expr("cast(array() as array<struct<before:string,after:string>>)").alias("path"))
    above = materialise(paths(tops, start).select(F.col("name").alias("src"), F.col("leaf").alias("subroot"), "path"))
    proofs = paths(rounds, above)
    return proofs.select(
        "doc_id",
        F.when(F.col("src") != "0", F.expr("substr(src, 2)")).alias("source"),
        "pos",
        "leaf",
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        F.expr("sha2(array_join(transform(path, x -> x.before || x.after), ''), 256)").alias("proof_sha256"),
        F.expr("aggregate(path, coalesce(tampered, leaf), (h, x) -> sha2(concat(x.before, h, x.after), 256))").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
