import os
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import factors, metrics, neighbours, popularity, recommend, terms
from clickloom.plans import training
from clickloom.schemas import FACTOR_MODEL, POPULARITY_MODEL, EmptyTable
from clickloom.session import materialise

PAIRS = "user_id string, article_id string"


def brute_neighbours(ids, table, seeds, k):
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    u = table / np.where(norms > 0, norms, 1)
    out = {}
    for i in seeds:
        sims = u @ u[i]
        order = sorted(range(len(ids)), key=lambda j: (-round(sims[j], 9), ids[j]))[:k]
        out[ids[i]] = [(ids[j], round(float(sims[j]), 6)) for j in order]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("seed_id", "rank").collect():
        out.setdefault(r["seed_id"], []).append((r["article_id"], round(r["similarity"], 6)))
    return out


@pytest.mark.parametrize("pivots,chunk", [(1, 2048), (12, 25), (40, 10)])
def test_dense_neighbours_equal_brute_force(spark, pivots, chunk):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 4
    # A third of all vectors lies in one cluster; some are equal, opposite or zero.
    table = np.vstack([centres[0] + rng.normal(size=(130, 6)) * 0.2] + [c + rng.normal(size=(36, 6)) for c in centres[1:]])
    table[5] = table[6]
    table[7] = -table[8]
    table[9] = table[10] = 0.0
    ids = [f"i{j:03d}" for j in range(len(table))]
    items = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, table)], "article_id string, embedding array<double>")
    got = collected(neighbours.dense_neighbours(items, k=20, chunk_rows=chunk, max_pivots=pivots))
    want = brute_neighbours(ids, table, range(len(ids)), 20)
    assert set(got) == set(want)
    for i in ids:
        assert [x for x, _ in got[i]] == [x for x, _ in want[i]], i
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], atol=2e-6)
    some = collected(neighbours.dense_neighbours(items, items.where("article_id < 'i004'"), k=20, chunk_rows=chunk, max_pivots=pivots))
    assert some == {i: got[i] for i in ids[:4]}


def test_far_clusters_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(4)
    table = np.vstack([np.eye(6)[c] * 10 + rng.normal(size=(100, 6)) * 0.1 for c in range(6)])
    items = spark.createDataFrame([(f"i{j:03d}", v.tolist()) for j, v in enumerate(table)], "article_id string, embedding array<double>")
    visited = []
    plain = neighbours._score_blocks

    def counting(items, visits, *rest):
        visited.append(visits.count())
        return plain(items, visits, *rest)

    monkeypatch.setattr(neighbours, "_score_blocks", counting)
    neighbours.dense_neighbours(items, k=5, chunk_rows=20, max_pivots=30).count()
    assert sum(visited) < 600 * 20


def test_blocks_grow_with_the_table():
    small, large = neighbours._block_rows(10_000, 10_000, 2000, 8), neighbours._block_rows(10**8, 10**6, 512, 8000)
    assert small == neighbours.MIN_ROWS and 10 * small < large <= neighbours.BLOCK_BYTES // 512
    assert neighbours._block_rows(0, 0, 1, 8) == neighbours.MIN_ROWS


def test_fewer_items_than_neighbours(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [-1.0, 0.0]), ("z", [0.0, 0.0])], "article_id string, embedding array<double>")
    got = collected(neighbours.dense_neighbours(items))
    assert got["a"] == [("a", 1.0), ("z", 0.0), ("b", -1.0)] and len(got["z"]) == 3


TEXTS = [
    ("d0", "red apple red pie"),
    ("d1", "green apple tart"),
    ("d2", "red car red red car"),
    ("d3", "the and of"),
    ("d4", "red apple red pie"),
    ("d5", "quantum physics lecture"),
]


def tfidf_by_hand(texts, stop, cap):
    words = {d: [t for t in text.split() if t not in stop] for d, text in texts}
    total, df = {}, {}
    for ws in words.values():
        for w in ws:
            total[w] = total.get(w, 0) + 1
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    vocab = sorted(sorted(total), key=lambda w: -total[w])[:cap]
    out = {}
    for d, ws in words.items():
        raw = {w: ws.count(w) * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w in set(ws) if w in vocab}
        n = math.sqrt(sum(x * x for x in raw.values()))
        out[d] = {w: x / n for w, x in raw.items()}
    return out


@pytest.mark.parametrize("cap", [20000, 4])
def test_tfidf_equals_hand_computation(spark, cap):
    docs = spark.createDataFrame(TEXTS, "article_id string, text string")
    want = tfidf_by_hand(TEXTS, {"the", "and", "of"}, cap)
    got = {}
    for r in terms.tfidf(docs, max_terms=cap).collect():
        got.setdefault(r["article_id"], {})[r["term"]] = r["weight"]
    assert got.keys() == {d for d, ws in want.items() if ws}
    for d in got:
        assert got[d] == pytest.approx(want[d])


def test_sparse_neighbours_equal_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    texts = [(f"d{i:02d}", " ".join(rng.choices(words, weights=range(1, 41), k=rng.randrange(1, 30)))) for i in range(80)]
    weights = tfidf_by_hand(texts, set(), 20000)
    rows, _ = terms.tfidf_rows(spark.createDataFrame(texts, "article_id string, text string"), stop_words=[])
    got = collected(neighbours.sparse_neighbours(rows, k=10, chunk_rows=9))
    for d in weights:
        sims = {e: sum(x * weights[e].get(w, 0) for w, x in weights[d].items()) for e in weights}
        order = sorted((e for e in sims if sims[e] > 0), key=lambda e: (-round(sims[e], 9), e))[:10]
        assert [e for e, _ in got[d]] == order


@pytest.mark.parametrize("chunk", [7, 2048])
def test_pruned_text_search_equals_brute_force_and_skips(spark, chunk):
    rng = random.Random(2)
    texts = []
    for i in range(240):  # three vocabularies with a few words in common; a third of all texts are nearly alike
        words = [f"{'abc'[i % 3]}{j}" for j in range(60)] + ["shared", "common"]
        texts.append((f"d{i:03d}", " ".join(words[:40] + ["x%d" % (i % 5)] if i % 3 == 0 else rng.choices(words, k=rng.randrange(1, 60)))))
    rows = materialise(terms.tfidf_rows(spark.createDataFrame(texts, "article_id string, text string"), stop_words=[])[0])
    clustered = collected(neighbours.sparse_neighbours(rows, k=10, chunk_rows=chunk, cluster_rows=20))
    assert clustered == collected(neighbours.sparse_neighbours(rows, k=10, chunk_rows=2048))
    few = spark.createDataFrame([(f"d{i:03d}",) for i in (0, 1, 2, 100)] + [("none",)], "article_id string")
    assert collected(neighbours.sparse_neighbours(rows, few, k=10, chunk_rows=chunk, cluster_rows=20)) == {d: clustered[d] for d in ("d000", "d001", "d002", "d100")}

    known, matrix = neighbours._text_pivots(rows, 12)
    assigned = materialise(rows.mapInPandas(neighbours._assign_texts(known, matrix), "article_id string, terms array<int>, weights array<double>, _g int"))
    groups = np.array(sorted(r["_g"] for r in assigned.select("_g").distinct().collect()), np.int32)
    index = spark.sparkContext.broadcast(neighbours.term_ceilings(assigned, 12, 1024))
    floors = {d: near[9][1] if len(near) == 10 else 0.0 for d, near in clustered.items()}
    floor = F.element_at(F.create_map(*[F.lit(x) for kv in floors.items() for x in kv]), F.col("article_id"))
    asked = assigned.select(F.col("article_id").alias("seed_id"), F.col("terms").alias("q_terms"), F.col("weights").alias("q_weights"), floor.alias("q_floor"), F.col("_g").alias("_home"))
    plan = neighbours._plan_text_visits(index, groups)
    visits = asked.mapInPandas(plan, "seed_id string, q_terms array<int>, q_weights array<double>, q_floor double, _g int")
    assert 0 < visits.count() < 0.5 * len(texts) * (len(groups) - 1)


def test_shared_places_only_raise_the_ceilings(spark):
    rows = spark.createDataFrame([("a", [0, 5], [0.6, 0.8], 0), ("b", [1, 4], [0.1, 0.9], 1)], "article_id string, terms array<int>, weights array<double>, _g int")
    exact, shared = neighbours.term_ceilings(rows, 2, 8), neighbours.term_ceilings(rows, 2, 4)
    assert exact[0, 5] >= 0.8 * 255 and exact[0, 1] == 0 and shared[0, 1] == exact[0, 5] and shared[1, 0] == exact[1, 4]


def sequential_fill(own, seen, popular, k):
    out = []
    for source in (own, popular):
        for a in source:
            if len(out) < k and a not in seen and a not in out:
                out.append(a)
    return out


def test_fill_equals_sequential_fill(spark):
    rng = random.Random(9)
    popular = [f"p{i:03d}" for i in range(300)]
    users, own, seen, want = [], [], [], {}
    for i in range(60):
        user, k = f"u{i}", rng.randrange(1, 21)
        # Some users have seen nearly everything, some only the head of the ranking.
        mine = rng.choice([set(), set(rng.sample(popular, 30)), set(popular[:100]), set(popular[: rng.randrange(280, 300)]), set(popular)])
        scored = {a: round(rng.random(), 3) for a in rng.sample(popular, rng.choice([0, 3, 25]))}
        users.append((user, k))
        own += [(user, a, s) for a, s in scored.items()]
        seen += [(user, a) for a in mine]
        want[user] = sequential_fill(sorted(scored, key=lambda a: (-scored[a], a)), mine, popular, k)
    u = spark.createDataFrame(users, "user_id string, k int")
    ranking = spark.createDataFrame([(a, i + 1) for i, a in enumerate(popular)], "article_id string, pop_rank int")
    recs = popularity.fill_with_popular(
        u, spark.createDataFrame(own, PAIRS + ", score double"), spark.createDataFrame(seen, PAIRS), ranking
    )
    got = {user: {} for user, _ in users}
    for r in recs.collect():
        got[r["user_id"]][r["rank"]] = r["article_id"]
    for user in want:
        assert sorted(got[user]) == list(range(1, len(want[user]) + 1))
        assert [got[user][i + 1] for i in range(len(want[user]))] == want[user]


def test_popularity_ties_by_id(rows):
    got = popularity.popularity_ranking(rows([("u", "b"), ("u", "a"), ("v", "c"), ("w", "c")], PAIRS)).orderBy("pop_rank")
    assert [(r["article_id"], r["pop_rank"]) for r in got.collect()] == [("c", 1), ("a", 2), ("b", 3)]


def test_seeds_are_cut_before_the_index_is_checked(rows):
    data = [("u", f"a{i}", i) for i in range(5)] + [("v", "a1", 1)] + [("w", "x", 2), ("w", "a1", 1)]
    hist = rows(data, PAIRS + ", timestamp int")
    known = rows([("a0",), ("a1",), ("a3",)], "article_id string")
    got = sorted(map(tuple, recommend.seed_items(hist, known).collect()))
    assert got == [("u", "a3"), ("v", "a1"), ("w", "a1")]


def test_profile_seeds_recent_or_tail(rows):
    profs = rows([("u", ["n", "b", "c", "d", "o"]), ("v", ["n"])], "user_id string, recent_clicks array<string>")
    known = rows([(x,) for x in "nbcdo"], "article_id string")
    recent = sorted(map(tuple, recommend.profile_seeds(profs, known).collect()))
    tail = sorted(map(tuple, recommend.profile_seeds(profs, known, which="tail").collect()))
    assert recent == [("u", "b"), ("u", "c"), ("u", "n"), ("v", "n")]
    assert tail == [("u", "c"), ("u", "d"), ("u", "o"), ("v", "n")]


def test_repeated_seeds_count_twice_and_self_is_left_out(rows):
    seeds = rows([("u", "a"), ("u", "a"), ("u", "b")], PAIRS)
    near = rows([("a", "a", 1.0), ("a", "c", 0.5), ("b", "c", -0.2), ("b", "a", 0.1)], "seed_id string, article_id string, similarity double")
    got = {r["article_id"]: r["score"] for r in recommend.item_scores(seeds, near).collect()}
    assert got == pytest.approx({"c": 0.8, "a": 0.1})


def test_requests_are_cleaned(rows):
    got = recommend.clean_requests(rows([(" u ", 99), ("", 5), (None, 5), ("v", None), ("w", -1)], "user_id string, k int")).collect()
    assert [tuple(r) for r in got] == [("u", 20, True), ("", 5, False), ("", 5, False), ("v", 10, True), ("w", 1, True)]


def test_unknown_model_is_refused(rows):
    req = recommend.clean_requests(rows([("u", 1)], "user_id string, k int"))
    profs = rows([("u", ["a"])], "user_id string, recent_clicks array<string>")
    ranking = rows([("a", 1), ("b", 2)], "article_id string, pop_rank int")
    with pytest.raises(recommend.UnknownModel):
        recommend.recommend_for_requests(req, profs, "other", ranking)
    assert [r["article_id"] for r in recommend.recommend_for_requests(req, profs, POPULARITY_MODEL, ranking).collect()] == ["b"]


def test_cold_users_get_popular_items(rows):
    req = recommend.clean_requests(rows([("new", 2), ("u", 2)], "user_id string, k int"))
    profs = rows([("u", ["a"]), ("other", ["b"])], "user_id string, recent_clicks array<string>")
    ranking = rows([("a", 1), ("b", 2), ("c", 3)], "article_id string, pop_rank int")
    items = rows([("a", [1.0, 0.0]), ("c", [1.0, 0.1])], "article_id string, embedding array<double>")
    got = {}
    for r in recommend.recommend_for_requests(req, profs, FACTOR_MODEL, ranking, items).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["article_id"])
    assert got == {"new": ["a", "b"], "u": ["c", "b"]}


def test_details_keep_rank_and_drop_unknown(rows):
    recs = rows([("u", "a", 1), ("u", "zz", 2), ("u", "b", 3), ("u", "a", 101)], PAIRS + ", rank int")
    arts = rows([("a", "A", None), ("b", None, "x")], "article_id string, title string, url string")
    got = [tuple(r)[:5] for r in recommend.with_details(recs, arts, cap=100).orderBy("rank").collect()]
    assert got == [("u", 1, "a", "A", ""), ("u", 3, "b", "", "x")]


def test_metrics_by_hand(rows):
    recs = rows(
        [("u", f"a{i}", i + 1) for i in range(10)] + [("v", "x", 1)] + [("no_truth", "a0", 1)], PAIRS + ", rank int"
    )
    truth = rows([("u", "a0"), ("u", "a0"), ("u", "a6"), ("u", "zz"), ("v", "y"), ("w", "q")], PAIRS)
    got = {r["user_id"]: r for r in metrics.user_metrics(recs, truth).collect()}
    assert set(got) == {"u", "v", "w"}
    assert got["u"]["precision"] == pytest.approx(1 / 5) and got["u"]["recall"] == pytest.approx(2 / 3)
    ideal = sum(1 / math.log2(i + 1) for i in (1, 2, 3))
    assert got["u"]["ndcg"] == pytest.approx((1 + 1 / math.log2(8)) / ideal)
    assert got["v"]["ndcg"] == 0 and got["w"]["recall"] == 0
    mean = metrics.evaluate(recs, truth).first()
    assert mean["eval_users"] == 3 and mean["precision_at_5"] == pytest.approx(1 / 15)
    assert tuple(metrics.evaluate(recs, truth.where("false")).first()) == (0.0, 0.0, 0.0, 0)


def test_more_truth_than_k_is_capped_in_the_ideal(rows):
    recs = rows([("u", f"a{i}", i + 1) for i in range(10)], PAIRS + ", rank int")
    truth = rows([("u", f"a{i}") for i in range(30)], PAIRS)
    got = metrics.user_metrics(recs, truth).first()
    assert got["ndcg"] == pytest.approx(1.0) and got["recall"] == pytest.approx(1 / 3) and got["precision"] == 1.0


def test_best_run(rows):
    schema = "run_id string, status string, model_type string, ndcg_at_10 double, precision_at_5 double, recall_at_10 double"
    data = [
        ("r1", "FINISHED", "popularity_baseline", 0.5, 0.1, 0.9),
        ("r2", "FINISHED", "knn_content_based", 0.5, 0.2, 0.1),
        ("r3", "FINISHED", "svd_matrix_factorisation", 0.5, 0.2, 0.1),
        ("r4", "RUNNING", "popularity_baseline", 0.9, 0.9, 0.9),
        ("r5", "FINISHED", "other", 0.9, 0.9, 0.9),
        ("r6", "FINISHED", "popularity_baseline", None, 0.9, 0.9),
    ]
    assert metrics.require_best_run(rows(data, schema))["run_id"] == "r2"
    with pytest.raises(EmptyTable):
        metrics.require_best_run(rows(data[3:5], schema))


@pytest.mark.parametrize("per_block", [factors.PAIRS_PER_BLOCK, 9])
def test_factors_match_exact_svd(spark, per_block):
    rng = np.random.default_rng(0)
    left, right = rng.normal(size=(70, 5)), rng.normal(size=(40, 5))
    a = np.maximum(np.round(left @ right.T), 0)
    pairs = [(f"u{j}", f"i{i}", float(a[i, j])) for i in range(70) for j in range(40) if a[i, j] > 0]
    made = factors.item_factors(spark.createDataFrame(pairs, "user_id string, article_id string, weight double"), 6, pairs_per_block=per_block)
    got = {r["article_id"]: np.array(r["embedding"]) for r in made.collect()}
    keep = [i for i in range(70) if f"i{i}" in got]
    f = np.vstack([got[f"i{i}"] for i in keep])
    u, s, _ = np.linalg.svd(a[keep], full_matrices=False)
    assert f.shape[1] == 6
    # Columns are singular vectors times singular values: lengths and residuals match.
    assert np.allclose(np.sqrt((f**2).sum(axis=0)), s[:6], rtol=1e-4)
    gram = a[keep] @ a[keep].T
    assert np.linalg.norm(gram @ f - f * s[:6] ** 2) / np.linalg.norm(gram @ f) < 1e-3
    cosine = lambda m: (m / np.linalg.norm(m, axis=1, keepdims=True)) @ (m / np.linalg.norm(m, axis=1, keepdims=True)).T
    assert np.abs(cosine(f) - cosine(u[:, :6] * s[:6])).max() < 1e-2


def test_factor_products_leave_the_pairs_where_they_lie(spark, rows):
    rng = np.random.default_rng(3)
    # One article holds a third of all pairs.
    data = sorted({(f"u{rng.integers(90)}", f"i{rng.integers(40) * (rng.random() > 0.33)}") for _ in range(700)})
    pairs = rows([(u, i, float(1 + n % 4)) for n, (u, i) in enumerate(data)], PAIRS + ", weight double")
    vectors = {u: rng.normal(size=3) for u, _ in data}
    layout = factors.lay_out(pairs, "user_id", "article_id", len(data), 30)
    assert layout.split and layout.blocks.where("right = 'i0'").select("block").distinct().count() > 1
    made = factors.product(layout, rows([(u, *map(float, v)) for u, v in vectors.items()], "user_id string, f0 double, f1 double, f2 double"), 3)
    plan = made._jdf.queryExecution().executedPlan().toString().splitlines()
    top = next(n for n, line in enumerate(plan) if "FlatMapCoGroupsInArrow" in line)
    scan = next(n for n, line in enumerate(plan) if "FileScan" in line and "weight" in line)
    assert top < scan and not any("Exchange" in line for line in plan[top:scan])
    assert "SelectedBucketsCount" in plan[scan] and "Bucketed: true" in plan[scan]
    want = {}
    for n, (u, i) in enumerate(data):
        want[i] = want.get(i, 0) + (1 + n % 4) * vectors[u]
    got = {r["article_id"]: [r["f0"], r["f1"], r["f2"]] for r in made.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)


def test_component_count():
    assert [factors.component_count(*x) for x in ((1000, 900), (10, 30), (2, 2))] == [50, 9, 2]


def test_tiny_factor_tables(spark):
    made = factors.item_factors(spark.createDataFrame([("u", "a", 1.0), ("v", "b", 2.0)], PAIRS + ", weight double"))
    assert made.count() == 2


def test_checkpoints_go_to_the_named_folder(spark):
    assert materialise(spark.range(3).withColumn("x", F.lit(1))).count() == 3
    assert spark.sparkContext.getCheckpointDir() is not None


def test_no_hidden_caps(spark, rows):
    ranking = rows([(f"i{n:03d}", 100 - n, n + 1) for n in range(60)], "article_id string, clicks long, pop_rank long")
    nobody = rows([], PAIRS)
    asked = rows([("u", 50), ("v", 200)], "user_id string, k int")
    got = popularity.fill_with_popular(asked, None, nobody, ranking).groupBy("user_id").count().collect()
    assert {r["user_id"]: r["count"] for r in got} == {"u": 50, "v": 60}
    seen = rows([("u", f"i{n:03d}") for n in range(55)], PAIRS)
    few = popularity.fill_with_popular(rows([("u", 3), ("w", 9)], "user_id string, k int"), None, seen, ranking).collect()
    assert sorted((r["user_id"], r["article_id"]) for r in few) == [("u", f"i{n:03d}") for n in (55, 56, 57)] + [("w", f"i{n:03d}") for n in range(9)]
    runs = rows([(f"a{n:03d}", "FINISHED", POPULARITY_MODEL, float(n)) for n in range(150)], "run_id string, status string, model_type string, ndcg_at_10 double").withColumns(
        {"precision_at_5": F.lit(0.0), "recall_at_10": F.lit(0.0)}
    )
    assert metrics.best_run(runs).first()["run_id"] == "a149"
    users = spark.range(5200).select(F.col("id").cast("string").alias("user_id"))
    assert training.evaluation_users(users).count() == 5200


def test_a_hundred_components(spark):
    pairs = spark.range(150 * 140).select((F.col("id") % 150).cast("string").alias("user_id"), F.floor(F.col("id") / 150).cast("string").alias("article_id"), F.rand(3).alias("weight"))
    assert factors.item_factors(pairs, 100, power_steps=1).select(F.size("embedding").alias("n")).distinct().collect()[0]["n"] == 100


def test_no_text_crosses_a_shuffle(rows):
    docs = rows([("a", "alpha beta beta"), ("b", "beta gamma")], "article_id string, text string")
    plan = terms.term_counts(docs)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    below = plan.split("Exchange")[1].splitlines()[0]
    assert "term" in below or "text" not in below
    assert {(r["article_id"], r["term"], r["tf"]) for r in terms.term_counts(docs).collect()} == {("a", "alpha", 1), ("a", "beta", 2), ("b", "beta", 1), ("b", "gamma", 1)}


def test_sql_needs_no_jars():
    from clickloom.functions.text import STOP_WORDS
    from clickloom.registered import ORACLES, load

    load()
    assert len(STOP_WORDS) == 181 and "'ourselves'" in ORACLES["tfidf"] and "LIMIT 20000" not in ORACLES["tfidf"]


def test_factor_products_send_some_columns_at_a_time_and_leave_no_files(spark, rows, tmp_path, monkeypatch):
    """Columns sent one at a time give the same product; work files go but for the last vectors."""
    rng = np.random.default_rng(5)
    data = sorted({(f"u{rng.integers(30)}", f"i{rng.integers(20)}") for _ in range(200)})
    pairs = rows([(u, i, 1.0) for u, i in data], PAIRS + ", weight double")
    vectors = {u: rng.normal(size=3) for u, _ in data}
    monkeypatch.setattr(factors, "ROUTED_LEAST", 1)
    monkeypatch.setattr(factors, "ROUTED_PER_PAIR", 1)
    before = {t.name for t in spark.catalog.listTables()}
    layout = factors.lay_out(pairs, "user_id", "article_id", len(data))
    assert layout.columns == 1
    made, folders = factors.multiply(layout, rows([(u, *map(float, v)) for u, v in vectors.items()], "user_id string, f0 double, f1 double, f2 double"), 3)
    want = {}
    for u, i in data:
        want[i] = want.get(i, 0) + vectors[u]
    got = {r["article_id"]: [r["f0"], r["f1"], r["f2"]] for r in made.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)
    assert len(folders) == 1 and os.path.isdir(folders[0])
    factors.forget(layout)
    assert not any(os.path.exists(f) for f in layout.folders) and {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("asked", [None, ["b7", "b2", "c0"]])
def test_copies_of_a_text_are_searched_once(spark, rows, monkeypatch, asked):
    """Copies get the lists that a search among all rows gives, and only one of them is searched."""
    texts = {"a": "red bolt", "b": "red ring large", "c": "blue ring", "d": "blue bolt large ring"}
    docs = rows([(f"{t}{i}", words) for t, words in texts.items() for i in range(9 if t == "b" else 3)], "article_id string, text string")
    packed = materialise(terms.tfidf_rows(docs)[0])
    seeds = None if asked is None else rows([(a,) for a in asked], "article_id string")
    size = []
    search = neighbours._search_texts
    monkeypatch.setattr(neighbours, "_search_texts", lambda packed, *rest: size.append(packed.count()) or search(packed, *rest))
    show = lambda df: sorted((r["seed_id"], r["rank"], r["article_id"], round(r["similarity"], 9)) for r in df.collect())
    want = show(search(packed, seeds, 5, None, neighbours.TEXT_PIVOTS, neighbours.CLUSTER_ROWS))
    assert show(neighbours.sparse_neighbours(packed, seeds, 5)) == want and size == [4]
    assert len(want) == 5 * (18 if asked is None else 3)


@pytest.mark.parametrize("common", [1, 4, 1000])
def test_tfidf_joins_rare_terms_and_articles_of_several_texts(spark, monkeypatch, common):
    monkeypatch.setattr(terms, "COMMON_TERMS", common)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    texts = [(f"d{i}", " ".join(rng.choices(words, weights=range(1, 31), k=rng.randrange(1, 25)))) for i in range(20)] + [("none", None), ("d3", "w1 w1 unique"), ("stop", "the of")]
    docs = spark.createDataFrame(texts, "article_id string, text string").repartition(3)
    joined = {d: " ".join(t or "" for e, t in texts if e == d) for d, _ in texts}
    df = {w: sum(w in t.split() for t in joined.values()) for t in joined.values() for w in t.split()}
    want = {}
    for d, text in joined.items():
        raw = {w: text.split().count(w) * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w in text.split() if w not in ("the", "of")}
        want |= {(d, w): x / math.sqrt(sum(y * y for y in raw.values())) for w, x in raw.items()}
    got = {(r["article_id"], r["term"]): r["weight"] for r in terms.tfidf(docs).collect()}
    assert got == pytest.approx(want)
    rows, vocabulary = terms.tfidf_rows(docs)
    names = {r["ix"]: r["term"] for r in vocabulary.collect()}
    packed = rows.collect()
    assert all(list(r["terms"]) == sorted(r["terms"]) for r in packed)
    assert {(r["article_id"], names[t]): w for r in packed for t, w in zip(r["terms"], r["weights"])} == pytest.approx(want)


def test_common_terms_are_weighted_without_a_shuffle(rows):
    docs = rows([("a", "alpha beta beta"), ("b", "beta gamma")], "article_id string, text string")
    plan = terms.tfidf(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_few_seeds_meet_all_rows_where_these_lie(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = [(f"d{i:03d}", " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(150)] + [(f"c{i}", "w1 w2") for i in range(30)]
    packed = materialise(terms.tfidf_rows(spark.createDataFrame(texts, "article_id string, text string").repartition(3))[0])
    everything = collected(neighbours.sparse_neighbours(packed, k=5))
    few = spark.createDataFrame([("d001",), ("c7",), ("d001",), ("absent",)], "article_id string")

    def refuse(*_):
        raise AssertionError("rows were dealt into blocks")

    monkeypatch.setattr(neighbours, "_score_blocks", refuse)
    monkeypatch.setattr(neighbours, "MIN_ROWS", 16)
    got = collected(neighbours.sparse_neighbours(packed, few, k=5, cluster_rows=20))
    assert got == {d: everything[d] for d in ("d001", "c7")} and [e for e, _ in got["c7"]] == ["c0", "c1", "c10", "c11", "c12"]
    assert neighbours.sparse_neighbours(packed, few.where("article_id = 'absent'"), k=5, cluster_rows=20).isEmpty()


def test_text_knn_asks_for_every_document(spark):
    """Every document that has a term is a seed, whatever its id; the SQL asks for them all, too."""
    from clickloom import registered
    from clickloom.registered import tables

    registered.load()
    sf = "/root/testdata/sf0.001"
    with_terms = {r[0] for r in terms.tfidf(tables.document_texts(spark, sf)).select("article_id").distinct().collect()}
    seeds = {r[0] for r in registered.QUERIES["text_knn"](spark, sf).select("seed_id").distinct().collect()}
    assert seeds == with_terms and len(seeds) > 150
    assert "% 20" not in registered.ORACLES["text_knn"]


def test_text_search_sends_seeds_in_turns_and_keeps_only_the_lists(spark, tmp_path, monkeypatch):
    """Whatever number of clusters the seeds must visit, a round sends no more of them than the table has rows."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    texts = [(f"d{i:03d}", " ".join(rng.choices(words, k=rng.randrange(1, 9)))) for i in range(240)] + [(f"c{i}", "w1 w2") for i in range(9)]
    docs = spark.createDataFrame(texts, "article_id string, text string").repartition(3)
    want = collected(neighbours.sparse_neighbours(terms.tfidf_rows(docs)[0], k=5))
    sent, made, before = [], [], []
    score, write = neighbours._score_blocks, neighbours.write_scratch
    monkeypatch.setattr(neighbours, "_score_blocks", lambda items, visits, *rest: sent.append(visits.count()) or score(items, visits, *rest))
    monkeypatch.setattr(neighbours, "write_scratch", lambda *a, **b: before.append(write(*a, **b)) or before[-1])
    monkeypatch.setattr(neighbours, "ROUND_BYTES", 1, raising=False)
    rows = terms.tfidf_rows(docs, made=made)[0]
    got = neighbours.sparse_neighbours(rows, k=5, chunk_rows=2048, cluster_rows=20, used=made)
    assert collected(got) == want
    # Seeds are dealt to rounds by hash, so these differ somewhat in size.
    assert len(sent) > 3 and sum(sent) > 3 * 240 and max(sent) < 1.5 * 240
    kept = {os.path.basename(f).split("-")[0] for _, f in before if os.path.isdir(f)}
    assert kept == {"lists"} and len(made) == 2 and not any(os.path.isdir(f) for f in made)


def test_factor_blocks_are_packed_and_ids_without_vectors_left_out(spark, rows):
    """A block is one row of arrays, which no product parses again; ids of missing vectors do not count."""
    rng = np.random.default_rng(7)
    data = sorted({(f"u{rng.integers(50)}", f"i{rng.integers(30)}") for _ in range(300)}) + [("lone", "only")]
    pairs = rows([(u, i, float(1 + n % 3)) for n, (u, i) in enumerate(data)], PAIRS + ", weight double")
    vectors = {u: rng.normal(size=2) for u, _ in data if u not in ("lone", "u3", "u4")}
    layout = factors.lay_out(pairs, "user_id", "article_id", len(data), 40)
    assert layout.packs.count() == layout.packs.select("block").distinct().count() > 4
    assert layout.routes.count() == len({u for u, _ in data})
    made = factors.product(layout, rows([(u, *map(float, v)) for u, v in vectors.items()], "user_id string, f0 double, f1 double"), 2)
    want = {}
    for n, (u, i) in enumerate(data):
        if u in vectors:
            want[i] = want.get(i, 0) + (1 + n % 3) * vectors[u]
    got = {r["article_id"]: [r["f0"], r["f1"]] for r in made.collect()}
    assert "only" not in got and got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)
    factors.forget(layout)


def test_dense_blocks_leave_out_what_cannot_reach_the_floor(monkeypatch):
    """Screened in single precision, tile by tile; values that only double precision tells apart keep their order."""
    import pandas as pd

    rng = np.random.default_rng(9)
    monkeypatch.setattr(neighbours, "TILE", 64, raising=False)
    table = rng.normal(size=(500, 8))
    table[100:140] = table[100] + np.arange(40)[:, None] * 1e-8 * rng.normal(size=8)  # hardly different
    table[200:330] = table[200]  # equal
    table[400] = 0.0
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    unit = table / np.where(norm > 0, norm, 1)
    ids = [f"i{j:03d}" for j in range(500)]
    floors = np.where(np.arange(500) % 2, -2.0, 0.7)
    items = pd.DataFrame({"article_id": ids, "u": list(unit)})
    seeds = pd.DataFrame({"seed_id": ids, "q": list(unit), "q_floor": floors})
    got = neighbours._dense_block(5)(items, seeds)
    lists = {s: list(x["article_id"]) for s, x in got.groupby("seed_id")}
    for j, i in enumerate(ids):
        sims = unit @ unit[j]
        order = sorted(range(500), key=lambda e: (-round(sims[e], 9), ids[e]))[:5]
        assert lists.get(i, []) == [ids[e] for e in order if sims[e] >= floors[j] - neighbours._SLACK], i
    assert neighbours._dense_block(5)(items[:0], seeds).empty and neighbours._dense_block(5)(items, seeds[:0]).empty
