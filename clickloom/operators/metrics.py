"""Ranking metrics, run records and the choice of the best run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.casts import double_or
from clickloom.functions.ids import data_version
from clickloom.operators.ordering import ideal_gains
from clickloom.schemas import MODEL_TYPES, EmptyTable

PRECISION_K, RECALL_K, NDCG_K = 5, 10, 10


def user_metrics(
    recs: DataFrame, truth: DataFrame, precision_k: int = PRECISION_K, recall_k: int = RECALL_K, ndcg_k: int = NDCG_K
) -> DataFrame:
    """Precision, recall and nDCG per user with truth. The precision denominator is always k."""
    wanted = truth.select("user_id", "article_id").distinct()
    ranked = recs.select("user_id", "article_id", "rank").where(F.col("rank") <= max(precision_k, recall_k, ndcg_k))
    marked = wanted.join(ranked, ["user_id", "article_id"], "left")

    def hits(k: int):
        return F.count(F.when(F.col("rank") <= k, 1))

    gain = F.coalesce(F.sum(F.when(F.col("rank") <= ndcg_k, 1.0 / F.log2(F.col("rank") + 1.0))), F.lit(0.0))
    ideal = F.array(*[F.lit(g) for g in ideal_gains(ndcg_k)])
    return (
        marked.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_n"), hits(precision_k).alias("_p"), hits(recall_k).alias("_r"), gain.alias("_g"))
        .select(
            "user_id",
            (F.col("_p") / F.lit(float(precision_k))).alias("precision"),
            (F.col("_r") / F.col("_n")).alias("recall"),
            (F.col("_g") / F.element_at(ideal, F.least(F.col("_n"), F.lit(ndcg_k)).cast("int"))).alias("ndcg"),
        )
    )


def evaluate(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: mean metrics over users with truth, 0.0 without users."""
    zero = F.lit(0.0)
    return user_metrics(recs, truth).agg(
        F.coalesce(F.avg("ndcg"), zero).alias("ndcg_at_10"),
        F.coalesce(F.avg("precision"), zero).alias("precision_at_5"),
        F.coalesce(F.avg("recall"), zero).alias("recall_at_10"),
        F.count(F.lit(1)).alias("eval_users"),
    )


def split_sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row of dataset sizes, the same for every run on the split."""
    parts = train.agg(
        F.count(F.lit(1)).alias("train_size"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("article_id").alias("unique_articles"),
    ).unionByName(test.agg(F.count(F.lit(1)).alias("test_size")), allowMissingColumns=True)
    return parts.agg(*[F.max(n).alias(n) for n in parts.columns])


def run_record(run_id: str, model_type: str, metrics: DataFrame, sizes: DataFrame) -> DataFrame:
    """One finished run: metrics and dataset sizes."""
    both = metrics.unionByName(sizes, allowMissingColumns=True)
    names = ["ndcg_at_10", "precision_at_5", "recall_at_10", "train_size", "test_size", "unique_users", "unique_articles", "eval_users"]
    return both.agg(*[F.max(n).alias(n) for n in names]).select(
        F.lit(run_id).alias("run_id"), F.lit("FINISHED").alias("status"), F.lit(model_type).alias("model_type"), *names
    )


def candidate_runs(runs: DataFrame, known: list[str] = MODEL_TYPES) -> DataFrame:
    """Finished runs of known models, unreadable metrics as 0.0."""
    finished = runs.where(F.col("status") == "FINISHED")
    names = ["ndcg_at_10", "precision_at_5", "recall_at_10"]
    return finished.where(F.col("model_type").isin(known)).withColumns({n: double_or(F.col(n)) for n in names})


def best_run(runs: DataFrame, known: list[str] = MODEL_TYPES) -> DataFrame:
    """The run with the largest nDCG, then precision, then recall; ties by run id."""
    order = [F.col(n).desc() for n in ("ndcg_at_10", "precision_at_5", "recall_at_10")]
    return candidate_runs(runs, known).orderBy(*order, "run_id").limit(1)


def require_best_run(runs: DataFrame, known: list[str] = MODEL_TYPES):
    """The best run as one row for the promotion step."""
    row = best_run(runs, known).first()
    if row is None:
        raise EmptyTable("no finished run of a known model")
    return row


def promotion_record(best: DataFrame, stamp) -> DataFrame:
    """Metadata row of a promoted run at time text ``stamp`` (yyyyMMdd_HHmmss)."""
    return best.select(
        F.col("model_type").alias("best_model"),
        F.concat(F.lit("registry/best_model_"), stamp).alias("model_path"),
        stamp.alias("timestamp"),
        data_version(F.col("run_id"), stamp).alias("data_version"),
        "run_id",
        "ndcg_at_10",
        "precision_at_5",
        "recall_at_10",
        *[F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in ("train_size", "test_size", "unique_users", "unique_articles", "eval_users")],
    )
