"""Train the three recommenders, evaluate them, and promote the best."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.cleaning import drop_blank, model_text
from clickloom.operators.factors import item_factors
from clickloom.operators.interactions import pair_weights, seen_pairs
from clickloom.operators.metrics import best_run, evaluate, promotion_record, require_best_run, run_record, split_sizes
from clickloom.operators.ordering import sample_exact, split_exact
from clickloom.operators.popularity import fill_with_popular, popularity_ranking
from clickloom.operators.recommend import neighbours_for, recommend_from_neighbours, seed_items
from clickloom.operators.dedup import distinct_on
from clickloom.operators.terms import tfidf_rows
from clickloom.schemas import FACTOR_MODEL, MODEL_TYPES, POPULARITY_MODEL, TEXT_MODEL, require_rows
from clickloom.session import materialise
from clickloom.sources.writers import append_runs, promote, read_runs, save_model

EVAL_K = 10


@dataclass
class Split:
    train: DataFrame
    test: DataFrame


def split_interactions(interactions: DataFrame, test_share: float = 0.2, seed: int = 42) -> Split:
    """A repeatable split with exact sizes. ``interactions`` rows are distinct."""
    marked = split_exact(interactions, [F.col(c) for c in ("user_id", "article_id", "timestamp", "source")], test_share, seed)
    require_rows(marked, "interactions")
    return Split(marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test"))


def evaluation_users(test: DataFrame, limit: int | None = None, seed: int = 42, k: int = EVAL_K) -> DataFrame:
    """The users with held-out clicks; a repeatable sample of ``limit`` of them if given."""
    users = test.select("user_id").distinct()
    chosen = users if limit is None else sample_exact(users, ["user_id"], limit, seed)
    return chosen.withColumn("k", F.lit(k))


def text_rows(articles: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    texts = drop_blank(model_text(distinct_on(articles, ["article_id"])), "text")
    return tfidf_rows(texts.select("article_id", "text"), stop_words)[0]


def evaluate_models(
    split: Split, models: dict[str, DataFrame], root: str, version: str, max_users: int | None = None
) -> DataFrame:
    """Write the popularity ranking and the item tables of ``models`` below ``root``, evaluate popularity and
    each of them on the held-out clicks, and return all runs on record.

    The ranking is written once; other models refer to it. Training a version again replaces its runs.
    """
    spark = split.train.sparkSession
    users = materialise(evaluation_users(split.test, max_users))
    mine = materialise(split.train.join(users.select("user_id"), "user_id", "left_semi"))
    seen = materialise(seen_pairs(mine))
    truth = materialise(seen_pairs(split.test.join(users.select("user_id"), "user_id", "left_semi")))
    sizes = materialise(split_sizes(split.train, split.test))
    path = save_model(root, POPULARITY_MODEL, version, {"popularity": popularity_ranking(split.train)})
    ranking = spark.read.parquet(f"{path}/popularity")

    def record(model: str, recs: DataFrame) -> DataFrame:
        return run_record(f"{model}-{version}", model, evaluate(recs, truth), sizes)

    runs = [record(POPULARITY_MODEL, fill_with_popular(users, None, seen, ranking))]
    for model, rows in models.items():
        # Models are written once; evaluation reads the written tables.
        items = spark.read.parquet(f"{save_model(root, model, version, {'items': rows})}/items")
        seeds = materialise(seed_items(mine, items))
        near = neighbours_for(model, items, seeds)
        runs.append(record(model, recommend_from_neighbours(users, seeds, near, seen, ranking)))
    append_runs(reduce(DataFrame.unionByName, runs), root, version)
    return read_runs(spark, root)


def train_all(
    split: Split,
    articles: DataFrame,
    root: str,
    version: str,
    max_users: int | None = None,
    components: int = 50,
    given: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Train and evaluate the three models below ``root`` and return their run records, together with those of
    the item tables in ``given``, by model type."""
    made = {FACTOR_MODEL: item_factors(pair_weights(split.train), components), TEXT_MODEL: text_rows(articles)}
    return evaluate_models(split, made | (given or {}), root, version, max_users)


def promote_best(runs: DataFrame, root: str, version: str, stamp: str, known: list[str] = MODEL_TYPES) -> str:
    """Promote the best run's model: copies of all models of the version go below the registry, the promotion is
    added to its history, and the pointer to the best copy is set last."""
    best = require_best_run(runs, known)["model_type"]
    models = [r["model_type"] for r in runs.select("model_type").distinct().collect()]  # a few model types
    promote(runs.sparkSession, root, promotion_record(best_run(runs, known), F.lit(stamp)), models, version, stamp)
    return best
