"""Item-based recommendation for whole tables of users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.operators.cleaning import column_or_blank
from clickloom.operators.neighbours import dense_neighbours, sparse_neighbours
from clickloom.operators.ordering import top_n
from clickloom.operators.popularity import MAX_K, fill_with_popular
from clickloom.schemas import FACTOR_MODEL, POPULARITY_MODEL, TEXT_MODEL, VECTOR_MODEL
from clickloom.session import materialise

DEFAULT_K = 10
SEEDS = 3
DETAIL_COLUMNS = ["title", "url", "category", "source", "abstract", "pub_date", "data_source"]


class UnknownModel(ValueError):
    """The model type has no recommender."""


def clean_requests(requests: DataFrame, default_k: int = DEFAULT_K, max_k: int = MAX_K) -> DataFrame:
    """Trim the user, clamp ``k``; ``valid`` is false for blank users. A ``request_id`` is kept."""
    user = F.trim(F.coalesce(F.col("user_id").cast("string"), F.lit("")))
    k = F.least(F.greatest(F.coalesce(F.col("k").try_cast("int"), F.lit(default_k)), F.lit(1)), F.lit(max_k))
    named = [F.col("request_id")] if "request_id" in requests.columns else []
    return requests.select(*named, user.alias("user_id"), k.alias("k"), (user != "").alias("valid"))


def seed_items(
    history: DataFrame, known: DataFrame, n: int = SEEDS, order: list[Column] | None = None
) -> DataFrame:
    """The last ``n`` history rows per user that are known articles.

    The cut comes first: an unknown article inside the last ``n`` is not replaced. Repeated articles stay
    repeated. ``history`` needs ``user_id, article_id`` and the columns of ``order`` (newest first).
    """
    order = order or [F.col("timestamp").desc(), F.col("article_id")]
    last = top_n(history, ["user_id"], order, n, "_rn").select("user_id", "article_id")
    return last.join(known.select("article_id").distinct(), "article_id", "left_semi").select("user_id", "article_id")


def profile_seeds(profiles: DataFrame, known: DataFrame, n: int = SEEDS, which: str = "recent") -> DataFrame:
    """Seeds of profile lists (newest first): ``recent`` takes the newest, ``tail`` the list's end."""
    place = F.posexplode("recent_clicks").alias("_at", "article_id")
    rows = profiles.select("user_id", F.size("recent_clicks").alias("_n"), place)
    cut = F.col("_at") < n if which == "recent" else F.col("_at") >= F.col("_n") - n
    return (
        rows.where(cut).join(known.select("article_id").distinct(), "article_id", "left_semi").select("user_id", "article_id")
    )


def item_scores(seeds: DataFrame, neighbours: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """``user_id, article_id, score``: similarities of the seeds' neighbours, added up per candidate."""
    weighted = seeds.groupBy("user_id", F.col("article_id").alias("seed_id")).agg(F.count(F.lit(1)).alias("_times"))
    near = neighbours.where(F.col("article_id") != F.col("seed_id")).select("seed_id", "article_id", "similarity")
    scores = (
        weighted.join(near, "seed_id")
        .groupBy("user_id", "article_id")
        .agg(F.sum(F.col("_times") * F.col("similarity")).alias("score"))
    )
    return scores if seen is None else scores.join(seen, ["user_id", "article_id"], "left_anti")


def recommend_from_neighbours(
    users: DataFrame, seeds: DataFrame, neighbours: DataFrame, seen: DataFrame, popularity: DataFrame
) -> DataFrame:
    """Neighbour candidates first, popular items in the remaining places (also for users without seeds)."""
    mine = seeds.join(users.select("user_id"), "user_id", "left_semi")
    return fill_with_popular(users, item_scores(mine, neighbours), seen, popularity)


def neighbours_for(model_type: str, items: DataFrame, seeds: DataFrame) -> DataFrame:
    """Neighbours of the distinct seeds in the model's item table."""
    if model_type in (FACTOR_MODEL, VECTOR_MODEL):
        return dense_neighbours(items, seeds)
    if model_type == TEXT_MODEL:
        return sparse_neighbours(items, seeds)
    raise UnknownModel(f"no recommender for model type {model_type}")


def recommend_for_requests(
    requests: DataFrame,
    profiles: DataFrame,
    model_type: str,
    popularity: DataFrame,
    items: DataFrame | None = None,
    which: str = "recent",
) -> DataFrame:
    """A ranked list for every valid cleaned request, by the model's type.

    Lists are made once per user, at the largest ``k`` asked for, and cut for each request. Rows carry the
    request's ``request_id`` if it has one. ``items`` is the model's item table: factor vectors, or packed
    term rows.
    """
    lists = _user_lists(requests, profiles, model_type, popularity, items, which)
    asked = requests.where("valid").drop("valid")
    return lists.join(asked, "user_id").where(F.col("rank") <= F.col("k")).drop("k")


def _user_lists(
    requests: DataFrame, profiles: DataFrame, model_type: str, popularity: DataFrame, items: DataFrame | None, which: str
) -> DataFrame:
    users = requests.where("valid").groupBy("user_id").agg(F.max("k").alias("k"))
    mine = profiles.join(users.select("user_id"), "user_id", "left_semi")
    seen = mine.select("user_id", F.explode("recent_clicks").alias("article_id"))
    if model_type == POPULARITY_MODEL:
        return fill_with_popular(users, None, seen, popularity)
    if items is None or model_type not in (FACTOR_MODEL, TEXT_MODEL, VECTOR_MODEL):
        raise UnknownModel(f"no recommender for model type {model_type}")
    seeds = materialise(profile_seeds(mine, items, which=which))
    near = neighbours_for(model_type, items, seeds)
    return recommend_from_neighbours(users, seeds, near, seen, popularity)


def with_details(recs: DataFrame, articles: DataFrame, cap: int | None = None) -> DataFrame:
    """Recommendations with article columns by rank; unknown ids drop out, missing values are blank. ``cap`` keeps the first ranks only."""
    facts = articles.select("article_id", *[column_or_blank(articles, c).alias(c) for c in DETAIL_COLUMNS])
    named = ["request_id"] if "request_id" in recs.columns else []
    chosen = recs if cap is None else recs.where(F.col("rank") <= cap)
    return chosen.join(facts, "article_id").select(*named, "user_id", "rank", "article_id", *DETAIL_COLUMNS)
