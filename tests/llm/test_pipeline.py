"""The pipeline's stages on planted cases, against brute force."""

import random

import pytest

import corpus_pipeline
from clickloom.llm import langid, pii
from tests.llm.test_decontaminate import brute
from tests.llm.test_neardup import classes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, told_lang int, spans string"


def prose(rng, lang, n):
    letters = {"aa": "abcdefgh", "bb": "mnopqrst"}[lang]
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    items = [(i, prose(rng, "aa", rng.randint(8, 40))) for i in range(12)]
    docs = []
    for i in range(80):
        lang = rng.choice(["aa", "bb"])
        text = prose(rng, lang, rng.randint(30, 120))
        if i % 10 == 0:
            text += " " + items[i // 10][1] + " " + prose(rng, lang, 3)
        if i % 10 == 1:
            text += " mail a.b@mail.example.com now"
        docs.append((i, text, lang if i % 4 else None))
    docs += [(100 + i, docs[i][1], "aa") for i in range(20, 25)]
    docs += [(200 + i, docs[i][1] + " tail", "aa") for i in range(30, 35)]
    docs += [docs[40], (300, None, "aa"), (301, "", None), (302, "123 ... 456", "aa"), (303, "яя жжжж шшшш щщщщщ", None)]
    root = str(tmp_path_factory.mktemp("corpus"))
    df = spark.createDataFrame([(d, t, lang, "s", len(t) if t else 0, 1, "x") for d, t, lang in docs], SCHEMA)
    df.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, docs, items


def test_stages(spark, folder):
    root, docs, items = folder
    df = spark.read.parquet(f"{root}/documents.parquet")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        df = spark.createDataFrame(stage(spark, df, root).collect(), df.schema) if name != "bpe" else stage(spark, df, root)
        results[name] = df.collect()
        if name != "bpe":
            assert df.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    ids = {name: sorted(r.doc_id for r in rows) for name, rows in results.items()}
    assert ids["language_id"] == sorted(d for d, *_ in docs if d < 300)
    assert all(r.lang in ("aa", "bb") for r in results["language_id"])
    top = classes([(r.doc_id, r.text) for r in results["language_id"]])
    assert ids["near_dedup"] == sorted({d for d, t in top.items() if d == t})
    held = {d for d, *_ in brute({(r.doc_id, r.text) for r in results["near_dedup"]}, items, 0.8)}
    assert held and ids["decontaminate"] == [d for d in ids["near_dedup"] if d not in held]
    assert ids["personal_data"] == ids["decontaminate"] == ids["bpe"]
    assert any("<EMAIL>" in r.text for r in results["personal_data"])
    assert not any(pii.base_spans(r.text) for r in results["personal_data"])
    assert all(r.n_chars == len(r.text) for r in results["personal_data"])
    assert all(r.round_trip and r.n_tokens == len(r.ids) > 0 for r in results["bpe"])


def test_run_and_empty_table(spark, folder, tmp_path):
    root, _, _ = folder
    assert corpus_pipeline.run(spark, root).count() > 50
    spark.read.parquet(f"{root}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{root}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_stay_where_the_share_cuts(spark):
    rng = random.Random(4)
    common = ["the", "house", "water", "morning", "people"]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rare = ["".join(rng.choices(letters, k=8)) for _ in range(20_000)]
    docs = [(i, " ".join(w for r in rare[40 * i : 40 * i + 40] for w in (r, rng.choice(common))), "en") for i in range(500)]
    docs += [(1000, "A.", "en"), (1001, "A.", None), (1002, " ".join(rare[:6]), "en"), (1003, " ".join(rare[6:9]), None), (1004, "12 ... 3", "en")]
    docs += [(1005, "яяжж шшщщ ююээ ыыъъ " * 20, None), (1006, docs[7][1], None), (1007, None, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    filters = langid.train(df)
    assert filters.languages == ["en"] and 0.2 < filters.reach[0] < 0.9
    (scored,) = langid.identify(df.where("doc_id = 1002"), filters).collect()
    assert scored.score < 0.2
    kept = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, df, "").collect()}
    assert sorted(d for d in kept if d >= 1000) == [1000, 1001, 1002, 1003, 1006] and len(kept) == 505
    assert set(kept.values()) == {"en"}


def test_decontamination_judges_rows_not_ids(spark, tmp_path):
    item = "which of the following words stands for the seventh of all listed things in this row"
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"before {item} after", "a"), (None, "a clean text without an id", "b"), (5, "a clean text", "c"), (5, f"{item} again", "d"), (6, None, "e"), (None, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_key string")
    kept = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(r["row_key"] for r in kept.collect()) == ["b", "c", "e", "f"]
