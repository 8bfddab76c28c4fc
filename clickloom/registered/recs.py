"""Popularity, neighbours, factors, recommendations, metrics and serving."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from clickloom.operators import factors, interactions as inter, metrics, neighbours, popularity, recommend, terms
from clickloom.plans import serving, training
from clickloom.registered import query, tables
from clickloom.registered.sql import fill, last_three, metrics as metrics_sql, scores, term_neighbours, vector_neighbours
from clickloom.schemas import FACTOR_MODEL, POPULARITY_MODEL, TEXT_MODEL, VECTOR_MODEL
from clickloom.session import materialise, work_path
from clickloom.sources.writers import latest_model, read_runs


def _six(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("popularity", "SELECT article_id, clicks, pop_rank FROM pop")
def popularity_query(spark, sf):
    return popularity.popularity_ranking(tables.interactions(spark, sf))


@query(
    "exclude_seen",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS article_id
 FROM orders JOIN events ON user_id = o_custkey AND event_type = 'view' WHERE NOT EXISTS
 (SELECT 1 FROM inter i WHERE i.user_id = CAST(o_custkey AS VARCHAR) AND i.article_id = json_extract_string(props, '$.k'))""",
)
def exclude_seen(spark, sf):
    viewed = (
        tables.table(spark, sf, "events")
        .where(F.col("event_type") == "view")
        .select("user_id", F.get_json_object("props", "$.k").alias("article_id"))
        .distinct()
    )
    buyers = tables.table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id")).distinct()
    candidates = viewed.join(buyers, "user_id", "left_semi").withColumn("user_id", F.col("user_id").cast("string"))
    return popularity.exclude_seen(candidates, inter.seen_pairs(tables.interactions(spark, sf)))


@query("dense_knn", f"SELECT seed_id, article_id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ({vector_neighbours('vecs')})")
def dense_knn(spark, sf):
    return _six(neighbours.dense_neighbours(tables.vectors(spark, sf)), "similarity")


@query("tfidf", "SELECT article_id, term, round(weight, 6) AS weight FROM dterms")
def tfidf(spark, sf):
    return _six(terms.tfidf(tables.document_texts(spark, sf)), "weight")


def _near_documents(spark, sf, seeds=None):
    made = []
    packed = terms.tfidf_rows(tables.document_texts(spark, sf), made=made)[0]
    return neighbours.sparse_neighbours(packed, seeds, used=made)


@query("text_knn", f"SELECT seed_id, article_id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM ({term_neighbours('dterms')})")
def text_knn(spark, sf):
    return _six(_near_documents(spark, sf), "similarity")


@query("seed_items", last_three("dclicks", "(SELECT CAST(doc_id AS VARCHAR) AS article_id FROM labels)"))
def seed_items(spark, sf):
    known = tables.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("article_id"))
    return recommend.seed_items(_clicks(spark, sf), known)


def _clicks(spark, sf):
    return tables.document_clicks(spark, sf).withColumnRenamed("ts", "timestamp")


@query("item_knn_scores", "SELECT user_id, article_id, round(score, 6) AS score FROM dvscores")
def item_knn_scores(spark, sf):
    items = tables.vectors(spark, sf)
    seeds = materialise(recommend.seed_items(_clicks(spark, sf), items))
    return _six(recommend.item_scores(seeds, neighbours.dense_neighbours(items, seeds)), "score")


def _click_users(spark, sf):
    """Every customer and every clicking user asks for ten items."""
    customers = tables.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return customers.unionByName(tables.document_clicks(spark, sf).select("user_id")).distinct().withColumn("k", F.lit(10))


@query("recommend_popular", f"SELECT user_id, article_id, rank FROM ({fill('(SELECT DISTINCT user_id, 20 AS k FROM inter)', None, 'pairs', 'pop')})")
def recommend_popular(spark, sf):
    rows = tables.interactions(spark, sf)
    users = rows.select("user_id").distinct().withColumn("k", F.lit(20))
    ranking = popularity.popularity_ranking(rows)
    return popularity.recommend_popular(users, inter.seen_pairs(rows), ranking).select("user_id", "article_id", "rank")


@query("recommend_fallback", fill("dusers", "dvscores", "dseen", "dpop"))
def recommend_fallback(spark, sf):
    clicks = tables.document_clicks(spark, sf)
    items = tables.vectors(spark, sf)
    seeds = materialise(recommend.seed_items(_clicks(spark, sf), items))
    own = recommend.item_scores(seeds, neighbours.dense_neighbours(items, seeds))
    ranking = popularity.popularity_ranking(clicks)
    return popularity.fill_with_popular(_click_users(spark, sf), own, inter.seen_pairs(clicks), ranking)


def _from_neighbours(spark, sf, items, search):
    clicks = tables.document_clicks(spark, sf)
    seeds = materialise(recommend.seed_items(_clicks(spark, sf), items))
    ranking = popularity.popularity_ranking(clicks)
    users = clicks.select("user_id").distinct().withColumn("k", F.lit(10))
    recs = recommend.recommend_from_neighbours(users, seeds, search(items, seeds), inter.seen_pairs(clicks), ranking)
    return recs.select("user_id", "article_id", "rank")


_CLICKERS = "(SELECT DISTINCT user_id, 10 AS k FROM dclicks)"


@query("recommend_item_knn", f"SELECT user_id, article_id, rank FROM ({fill(_CLICKERS, 'dvscores', 'dseen', 'dpop')})")
def recommend_item_knn(spark, sf):
    return _from_neighbours(spark, sf, tables.vectors(spark, sf), neighbours.dense_neighbours)


@query("recommend_text_knn", f"SELECT user_id, article_id, rank FROM ({fill(_CLICKERS, 'dtscores', 'dseen', 'dpop')})")
def recommend_text_knn(spark, sf):
    return _from_neighbours(spark, sf, tables.document_texts(spark, sf), lambda _, seeds: _near_documents(spark, sf, seeds))


@query("svd_item_factors")
def svd_item_factors(spark, sf):
    made = factors.item_factors(inter.pair_weights(tables.interactions(spark, sf)))
    return made.select("article_id", F.posexplode("embedding").alias("component", "value"))


_TRACE = " + ".join(f"{{0}}[{7 * i + 1}]" for i in range(6))


@query(
    "svd_gram",
    f"""WITH RECURSIVE c AS (SELECT user_id, coalesce(category, '') AS category, count(*) AS w FROM inter GROUP BY ALL),
 e AS (SELECT a.category AS ca, b.category AS cb, CAST(sum(a.w * b.w) AS DOUBLE) AS v FROM c a JOIN c b USING (user_id) GROUP BY ALL),
 g AS (SELECT list(v ORDER BY ca, cb) AS g, list(ca ORDER BY ca, cb) AS ca, list(cb ORDER BY ca, cb) AS cb FROM e),
 t AS (SELECT *, {_TRACE.format('g')} AS tr FROM g),
 p(i, m) AS (SELECT 0, list_transform(range(36), lambda k: (CASE WHEN k % 7 = 0 THEN 1.0 ELSE 0.0 END) - g[k + 1] / tr) FROM t
  UNION ALL SELECT i + 1, list_transform(q, lambda x: x / ({_TRACE.format('q')})) FROM (SELECT i, list_transform(range(36), lambda k:
   list_sum(list_transform(range(6), lambda j: m[(k // 6) * 6 + j + 1] * m[j * 6 + k % 6 + 1]))) AS q FROM p WHERE i < 45)),
 s AS (SELECT m, list_dot_product(g, m) AS least FROM p CROSS JOIN t WHERE i = 45)
 SELECT ca[k] AS category_a, cb[k] AS category_b, round((g[k] - least * m[k]) / tr, 6) AS share FROM t CROSS JOIN s CROSS JOIN (SELECT unnest(range(1, 37)) AS k)""",
)
def svd_gram(spark, sf):
    """Five factors of the six categories by user: their inner products are the counts' without the smallest direction."""
    clicks = tables.interactions(spark, sf).select("user_id", F.coalesce("category", F.lit("")).alias("article_id"))
    made = materialise(factors.item_factors(inter.pair_weights(clicks), 5))
    # Six rows make one list, and the list its pairs.
    listed = made.agg(F.collect_list(F.struct("article_id", "embedding")).alias("all"))
    pairs = listed.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    pairs = pairs.select(F.col("x.article_id").alias("category_a"), F.col("y.article_id").alias("category_b"), F.col("x.embedding").alias("a"), F.col("y.embedding").alias("b"))
    pairs = pairs.withColumn("dot", F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))
    # The trace of the whole matrix, from the counts.
    trace = inter.pair_weights(clicks).agg(F.sum(F.col("weight") * F.col("weight"))).first()[0]
    return pairs.select("category_a", "category_b", F.round(F.col("dot") / float(trace), 6).alias("share"))


def _requests(spark, sf):
    """Customers ask for as many items as their nation number, many of them twice; some leave the user blank or the number out."""
    user = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("  ")).otherwise(F.concat(F.lit(" "), (F.col("c_custkey") - F.col("c_custkey") % 3).cast("string")))
    k = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey") - 1)
    return tables.table(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"), user.alias("user_id"), k.alias("k"))


_ASKED = """(SELECT c_custkey AS request_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE CAST(c_custkey - c_custkey % 3 AS VARCHAR) END AS user_id,
 CASE WHEN c_acctbal >= 0 THEN least(greatest(c_nationkey - 1, 1), 20) ELSE 10 END AS k FROM customer)"""
_REQUESTS = f"(SELECT user_id, max(k) AS k FROM {_ASKED} WHERE user_id <> '' GROUP BY user_id)"
_PROFILE_SEEN = "(SELECT user_id, article_id FROM drecent)"
_PROFILE_SEEDS = "SELECT user_id, article_id FROM drecent WHERE rn <= 3 AND article_id IN (SELECT article_id FROM vecs)"


def _profiles(spark, sf):
    """Recent clicks of the clicking users, newest first."""
    from clickloom.operators.vectors import recent_clicks

    clicks = tables.document_clicks(spark, sf)
    return recent_clicks(clicks, [F.col("ts").desc(), F.col("article_id")])


def _served(spark, sf, model):
    clicks = tables.document_clicks(spark, sf)
    return recommend.recommend_for_requests(
        recommend.clean_requests(_requests(spark, sf)),
        _profiles(spark, sf),
        model,
        popularity.popularity_ranking(clicks),
        tables.vectors(spark, sf) if model == FACTOR_MODEL else None,
    )


def _served_sql() -> str:
    near = vector_neighbours("vecs", f"({_PROFILE_SEEDS})")
    own = f"(SELECT s.user_id, n.article_id, sum(n.similarity) AS score FROM ({_PROFILE_SEEDS}) s JOIN ({near}) n ON n.seed_id = s.article_id WHERE n.article_id <> s.article_id GROUP BY ALL)"
    own = f"(SELECT * FROM {own} WHERE user_id IN (SELECT user_id FROM {_REQUESTS}))"
    return fill(_REQUESTS, own, _PROFILE_SEEN, "dpop")


def _per_request(lists: str, model: str) -> str:
    return f"""SELECT '{model}' AS model_type, q.request_id, l.user_id, l.article_id, l.rank, CAST(NULL AS VARCHAR) AS error
 FROM ({lists}) l JOIN {_ASKED} q ON q.user_id = l.user_id AND l.rank <= q.k"""


@query(
    "recommend_requests",
    f"""{_per_request(fill(_REQUESTS, None, _PROFILE_SEEN, 'dpop'), POPULARITY_MODEL)} UNION ALL {_per_request(_served_sql(), FACTOR_MODEL)}
 UNION ALL SELECT NULL, request_id, user_id, NULL, 0, 'a request needs a user' FROM {_ASKED} WHERE user_id = ''""",
)
def recommend_requests(spark, sf):
    out = [
        _served(spark, sf, model).select(F.lit(model).alias("model_type"), "request_id", "user_id", "article_id", "rank")
        for model in (POPULARITY_MODEL, FACTOR_MODEL)
    ]
    refused = serving.refuse_blank(_requests(spark, sf)).select("request_id", "user_id", F.lit(0).alias("rank"), "error")
    return out[0].unionByName(out[1]).unionByName(refused, allowMissingColumns=True)


def _part_facts(spark, sf):
    return tables.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("article_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("source"),
    )


@query(
    "recommendation_details",
    f"""SELECT r.user_id, r.rank, r.article_id, p_name AS title, '' AS url, coalesce(p_type, '') AS category, coalesce(p_brand, '') AS source,
 '' AS abstract, '' AS pub_date, '' AS data_source FROM ({fill('(SELECT DISTINCT user_id, 20 AS k FROM inter)', None, 'pairs', 'pop')}) r
 JOIN part ON CAST(p_partkey AS VARCHAR) = r.article_id""",
)
def recommendation_details(spark, sf):
    facts = _part_facts(spark, sf)
    # Rank 0 holds an id that no table has; it must drop out.
    recs = recommend_popular(spark, sf)
    unknown = recs.where("rank = 1").withColumns({"rank": F.lit(0), "article_id": F.lit("no such part")})
    return recommend.with_details(recs.unionByName(unknown), facts)


@query(
    "ranking_metrics",
    f"""SELECT round(ndcg_at_10, 6) AS ndcg_at_10, round(precision_at_5, 6) AS precision_at_5, round(recall_at_10, 6) AS recall_at_10, eval_users FROM ({metrics_sql('poprecs', 'etruth')})""",
)
def ranking_metrics(spark, sf):
    split = training.split_interactions(tables.distinct_interactions(spark, sf))
    users, seen, truth, ranking = _evaluation(split)
    return _six(metrics.evaluate(popularity.recommend_popular(users, seen, ranking), truth), "ndcg_at_10", "precision_at_5", "recall_at_10")


def _evaluation(split):
    users = materialise(training.evaluation_users(split.test))
    seen = inter.seen_pairs(split.train.join(users.select("user_id"), "user_id", "left_semi"))
    truth = inter.seen_pairs(split.test.join(users.select("user_id"), "user_id", "left_semi"))
    return users, materialise(seen), materialise(truth), popularity.popularity_ranking(split.train)


_KNOWN = [POPULARITY_MODEL, VECTOR_MODEL, TEXT_MODEL]


def _parts(spark, sf):
    return tables.catalogue(spark, sf).withColumn("article_id", F.substring("news_id", 2, 20))


_STAMP = "20240101_000000"
_TRAINED: dict[tuple[str, str], str] = {}


def _trained(spark, sf) -> str:
    """The folder of the training job over the tables in ``sf``, which runs once in a session: popularity, fitted
    factors, part texts and given vectors, of which the best but the factors is promoted."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        root = work_path(spark, "training")
        split = training.split_interactions(tables.distinct_interactions(spark, sf))
        runs = training.train_all(split, _parts(spark, sf), root, "v1", given={VECTOR_MODEL: tables.vectors(spark, sf)})
        training.promote_best(runs.where(F.col("model_type").isin(_KNOWN)), root, "v1", _STAMP, _KNOWN)
        _TRAINED[key] = root
    return _TRAINED[key]


def _runs(spark, sf):
    """Run records of three models: popularity, given vectors, part texts."""
    return read_runs(spark, _trained(spark, sf)).where(F.col("model_type").isin(_KNOWN))


_BEST = "(SELECT model_type FROM runs ORDER BY ndcg_at_10 DESC, precision_at_5 DESC, recall_at_10 DESC, run_id LIMIT 1)"


_RUN_COLUMNS = """run_id, 'FINISHED' AS status, model_type, round(ndcg_at_10, 6) AS ndcg_at_10, round(precision_at_5, 6) AS precision_at_5,
 round(recall_at_10, 6) AS recall_at_10, train_size, test_size, unique_users, unique_articles, eval_users"""


_SCORES = ["ndcg_at_10", "precision_at_5", "recall_at_10"]


@query(
    "train_evaluate",
    f"""SELECT {_RUN_COLUMNS}, true AS sound, model_type = {_BEST} AS promoted FROM runs CROSS JOIN sizes
 UNION ALL SELECT '{FACTOR_MODEL}-v1', 'FINISHED', '{FACTOR_MODEL}', NULL, NULL, NULL, train_size, test_size, unique_users, unique_articles,
  (SELECT max(eval_users) FROM runs), true, false FROM sizes""",
)
def train_evaluate(spark, sf):
    """The training job. The factors' scores have no unique values; ``sound`` says that all lie between 0 and 1."""
    root = _trained(spark, sf)
    fitted = F.col("model_type") == FACTOR_MODEL
    sound = reduce(lambda a, b: a & b, [F.col(n).between(0, 1) for n in _SCORES])
    promoted = F.col("model_type") == latest_model(spark, root)["best_model"]
    runs = read_runs(spark, root).withColumns({"sound": sound, "promoted": promoted})
    return _six(runs.withColumns({n: F.when(~fitted, F.col(n)) for n in _SCORES}), *_SCORES)


@query("run_log", f"SELECT {_RUN_COLUMNS} FROM runs CROSS JOIN sizes")
def run_log(spark, sf):
    return _six(_runs(spark, sf), *_SCORES)


@query(
    "best_model",
    """SELECT model_type AS best_model, 'registry/best_model_20240101_000000' AS model_path, '20240101_000000' AS "timestamp",
 substr(md5(run_id || '_20240101_000000'), 1, 8) AS data_version, run_id, round(ndcg_at_10, 6) AS ndcg_at_10, round(precision_at_5, 6) AS precision_at_5,
 round(recall_at_10, 6) AS recall_at_10, train_size, test_size, unique_users, unique_articles, eval_users
 FROM runs CROSS JOIN sizes ORDER BY runs.ndcg_at_10 DESC, runs.precision_at_5 DESC, runs.recall_at_10 DESC, run_id LIMIT 1""",
)
def best_model(spark, sf):
    record = metrics.promotion_record(metrics.best_run(_runs(spark, sf), _KNOWN), F.lit(_STAMP))
    return _six(record, *_SCORES)


@query(
    "model_registry",
    f"""SELECT model_type, model_type = {_BEST} AS promoted,
 (SELECT count(*) FROM tpop) AS popularity_rows, CASE model_type WHEN '{VECTOR_MODEL}' THEN (SELECT count(*) FROM embeddings)
  WHEN '{TEXT_MODEL}' THEN (SELECT count(DISTINCT article_id) FROM pterms) ELSE CAST(0 AS BIGINT) END AS item_rows FROM runs""",
)
def model_registry(spark, sf):
    root = _trained(spark, sf)
    best = latest_model(spark, root)["best_model"]
    out = []
    for model in _KNOWN:
        path = f"{root}/registry/all/{model}-{_STAMP}"
        sizes = spark.read.parquet(f"{path}/popularity").agg(F.count(F.lit(1)).alias("popularity_rows"))
        items = F.lit(0 if model == POPULARITY_MODEL else spark.read.parquet(f"{path}/items").count()).cast("bigint")
        out.append(sizes.select(F.lit(model).alias("model_type"), F.lit(model == best).alias("promoted"), "popularity_rows", items.alias("item_rows")))
    return reduce(DataFrame.unionByName, out)


def _near_lists(items: str, near) -> str:
    """Lists from the neighbours of the newest clicks in ``items``, and popular parts."""
    seeds = f"(SELECT user_id, article_id FROM drecent WHERE rn <= 3 AND article_id IN (SELECT article_id FROM {items}) AND user_id IN (SELECT user_id FROM {_REQUESTS}))"
    return fill(_REQUESTS, f"({scores(seeds, '(' + near(seeds) + ')')})", _PROFILE_SEEN, "tpop")


_LISTS = {
    POPULARITY_MODEL: fill(_REQUESTS, None, _PROFILE_SEEN, "tpop"),
    VECTOR_MODEL: _near_lists("vecs", lambda seeds: vector_neighbours("vecs", seeds)),
    TEXT_MODEL: _near_lists("ptext", lambda seeds: term_neighbours("pterms", seeds)),
}


@query(
    "serve_requests",
    f"""SELECT q.request_id, l.user_id, l.rank, l.article_id, p_name AS title, '' AS url, coalesce(p_type, '') AS category, coalesce(p_brand, '') AS source,
 '' AS abstract, '' AS pub_date, '' AS data_source, l.model_type
 FROM ({" UNION ALL ".join(f"SELECT '{model}' AS model_type, user_id, article_id, rank FROM ({lists})" for model, lists in _LISTS.items())}) l
 JOIN {_ASKED} q ON q.user_id = l.user_id AND l.rank <= q.k JOIN part ON CAST(p_partkey AS VARCHAR) = l.article_id
 WHERE l.model_type = {_BEST}""",
)
def serve_requests(spark, sf):
    """What the promoted model, read back from the registry, answers to every valid request."""
    return serving.serve(spark, _trained(spark, sf), _requests(spark, sf), _profiles(spark, sf), _part_facts(spark, sf))
