"""Item popularity and the fill of short recommendation lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.ordering import global_index, top_n
from clickloom.session import materialise

MAX_K = 20
_SPAN = 4096
# A prefix of the ranking up to this many rows is broadcast.
_PREFIX_ROWS = 20_000


def item_counts(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("article_id").agg(F.count(F.lit(1)).alias("clicks"))


def popularity_ranking(interactions: DataFrame) -> DataFrame:
    """``article_id, clicks, pop_rank``: most clicked first, ties by id, ranks from 1."""
    return global_index(item_counts(interactions), [F.col("clicks").desc(), F.col("article_id")], "pop_rank", 1)


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    return candidates.join(seen, ["user_id", "article_id"], "left_anti")


def fill_with_popular(
    users: DataFrame, own: DataFrame | None, seen: DataFrame, popularity: DataFrame
) -> DataFrame:
    """Ranked lists ``user_id, article_id, rank, tier``: own candidates first, then popular ones.

    ``users`` holds ``user_id, k`` with any ``k``; ``own`` holds scored candidates, one row per
    user and article; ``seen`` holds ``user_id, article_id`` pairs. Lists hold unseen, distinct items.

    Nearly every user finds enough items in the first ``2 * max(k)`` ranks. That prefix is broadcast when it
    is short, so the pairs a user has seen are filtered where they lie and never meet the whole ranking. Users who
    have seen most of the prefix are served from longer prefixes afterwards.
    """
    max_k = users.agg(F.max("k")).first()[0] or 0
    first = max(2 * max_k, 1)
    seen = seen.select("user_id", "article_id")
    if own is None:
        chosen, blocked = None, seen
        base = users.withColumn("_have", F.lit(0).cast("bigint"))
    else:
        fresh = exclude_seen(own.select("user_id", "article_id", "score"), seen)
        order = [F.round("score", 9).desc(), F.col("article_id")]
        ranked = top_n(fresh, ["user_id"], order, max_k).join(users, "user_id").where(F.col("rank") <= F.col("k"))
        chosen = materialise(ranked.select("user_id", "article_id", "rank"))
        blocked = seen.unionByName(chosen.select("user_id", "article_id"))
        held = chosen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_have"))
        base = users.join(held, "user_id", "left").fillna(0, subset=["_have"])

    ranks = popularity.select("article_id", F.col("pop_rank").cast("bigint").alias("pop_rank"))
    prefix = ranks.where(F.col("pop_rank") <= first)
    prefix = F.broadcast(prefix) if first <= _PREFIX_ROWS else prefix
    taken = blocked.join(prefix, "article_id").groupBy("user_id").agg(F.collect_set("pop_rank").alias("_taken"))
    every = F.sequence(F.lit(1).cast("bigint"), F.lit(first).cast("bigint"))
    need = (F.col("k") - F.col("_have")).cast("int")
    short = materialise(
        base.where(F.col("_have") < F.col("k"))
        .join(taken, "user_id", "left")
        .select("user_id", "_have", need.alias("_need"), F.array_except(every, F.coalesce("_taken", F.array().cast("array<bigint>"))).alias("_free"))
    )
    filled = (
        short.where(F.size("_free") >= F.col("_need"))
        .select("user_id", "_have", F.posexplode(F.slice("_free", F.lit(1), F.col("_need"))).alias("_at", "pop_rank"))
        .join(prefix, "pop_rank")
        .select("user_id", "article_id", (F.col("_have") + F.col("_at") + 1).alias("rank"))
    )
    rest = short.where(F.size("_free") < F.col("_need")).drop("_free")
    if not rest.isEmpty():
        filled = filled.unionByName(_fill_from_longer(rest, blocked, ranks, first, max_k))
    filled = filled.withColumn("tier", F.lit(2))
    if chosen is not None:
        filled = chosen.withColumn("tier", F.lit(1)).unionByName(filled)
    return filled.withColumn("rank", F.col("rank").cast("int"))


def _fill_from_longer(rest: DataFrame, blocked: DataFrame, ranks: DataFrame, first: int, max_k: int) -> DataFrame:
    """Popular items of users whose blocked items cover most of the head of the ranking.

    Counting a user's blocked items below a few fixed ranks tells which prefix, first * 4^j long, leaves
    enough items. A prefix is at most four times as long as the user's own blocked list allows, so the
    rows made here are linear in what these users have seen.
    """
    total = ranks.agg(F.max("pop_rank")).first()[0] or 0
    sizes = [first * 4]
    while sizes[-1] < total:
        sizes.append(sizes[-1] * 4)
    hits = blocked.join(rest.select("user_id"), "user_id", "left_semi").distinct().join(ranks, "article_id")
    counts = hits.groupBy("user_id").agg(*[F.count(F.when(F.col("pop_rank") <= s, 1)).alias(f"_c{s}") for s in sizes])
    fits = [F.when(F.lit(s) - F.coalesce(f"_c{s}", F.lit(0)) >= F.col("_need"), F.lit(s).cast("bigint")) for s in sizes]
    # The last prefix is the whole ranking: who finds too few items there gets what there is.
    sized = rest.join(counts, "user_id", "left").withColumn("_prefix", F.coalesce(*fits, F.lit(sizes[-1]).cast("bigint")))
    # Two explodes, because one array of a very long prefix would not fit a row.
    spans = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_prefix") - 1) / _SPAN)))
    sized = sized.select("user_id", "_have", "_need", "_prefix", spans.alias("_s"))
    upto = F.least(F.col("_prefix"), (F.col("_s") + 1) * _SPAN)
    steps = F.explode(F.sequence(F.col("_s") * _SPAN + 1, upto)).alias("pop_rank")
    open_ranks = sized.select("user_id", "_have", "_need", steps).join(
        hits.select("user_id", "pop_rank"), ["user_id", "pop_rank"], "left_anti"
    )
    best = top_n(open_ranks.join(ranks, "pop_rank"), ["user_id"], [F.col("pop_rank")], max_k, "_at")
    return best.where(F.col("_at") <= F.col("_need")).select(
        "user_id", "article_id", (F.col("_have") + F.col("_at")).alias("rank")
    )


def recommend_popular(users: DataFrame, seen: DataFrame, popularity: DataFrame) -> DataFrame:
    return fill_with_popular(users, None, seen, popularity)
