"""Every registered query of the subpackage on the smallest tables: against its SQL, or a brute-force digest."""

import hashlib
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from clickloom.llm import bpe, licenses, queries  # noqa: E402
from compare import difference, duck  # noqa: E402
from tests.llm.test_neardup import classes  # noqa: E402
from tests.llm.test_pii import plain as plain_pii  # noqa: E402
from tests.llm.test_quality import plain as plain_quality  # noqa: E402
from tests.llm.test_suffixes import brute as brute_suffixes  # noqa: E402

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture
def run(spark):
    return lambda name: {r["doc_id"]: r.asDict() for r in entry.queries()[name](spark, SF).collect()}


def test_all_are_registered():
    names = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert names == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert len(got) and difference(got, duck(SF).execute(entry.oracle_sql()[name]).df()) is None


def test_op2(run, docs):
    lib, got = Tokenizer.from_file(P.path("byte_bpe_50k.json")), run("op2_token_counts")
    for d, text, _ in docs:
        n = len(lib.encode(text, add_special_tokens=False).ids)
        assert got[d] == {"doc_id": d, "n_bytes": len(text.encode()), "n_tokens": n, "over_limit": n > 1024}


def test_op3(run, docs):
    got = run("op3_personal_data")
    for d, text, _ in docs:
        base = plain_pii(text)
        said = [f"{k}:{a}:{b}" for a, b, k in base]
        assert got[d]["base_sha256"] == sha(",".join(said))
        assert [got[d][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[2] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert set(said) <= set(got[d]["spans"].split(",")) | {""}


def test_op4(run, docs):
    ranks, _ = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    lib, got = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), run("op4_bpe_round_trip")
    for d, text, _ in docs:
        ids = lib.encode_ordinary(text)
        assert got[d] == {"doc_id": d, "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))), "decoded_sha256": sha(text)}


def test_op5(run, docs):
    scanner, got = licenses.Scanner(licenses.TEMPLATES), run("op5_license_scan")
    for d, text, _ in docs:
        found = scanner.judge(text)
        assert got[d]["n_blocks"] == len(found) and got[d]["n_exact"] == sum(x["verdict"] == "exact" for x in found)
        for line in ("Released under the MIT License.", "Licensed under the Apache License, Version 2.0."):
            assert (line in text) <= (got[d]["n_exact"] > 0)


def test_op6(run, docs):
    got = run("op6_language_id")
    held = [(d, lang) for d, _, lang in docs if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d, r in got.items() if r["held_out"]} == {d for d, _ in held}
    assert sum(got[d]["lang_pred"] == lang for d, lang in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_op7(run, docs):
    assert {d: r["class_id"] for d, r in run("op7_near_duplicates").items()} == classes([(d, t) for d, t, _ in docs])


def test_op9(run, docs):
    got = run("op9_quality_rules")
    for d, text, _ in docs:
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_quality(text)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) and not (r["base_failed"] and r["kept"])


def test_op10(run, docs):
    got = run("op10_suffix_dedup")
    for d, n, removed, spans, kept in brute_suffixes([(d, t) for d, t, _ in docs], 50):
        assert got[d] == {"doc_id": d, "n_bytes": n, "n_removed": removed, "n_spans": spans, "kept_sha256": sha(kept)}


def test_op12(spark):
    from tests.llm.test_whitening import same

    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = entry.queries()["op12_embedding_whitening"](spark, SF).collect()
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, away = len(fit), x - fit.mean(0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    deviation = ((n * x - fit.sum(0)) ** 2).sum(1)
    want = [(i, k + 1, n, int(deviation[at]), abs(away[at] @ axes[:, -1 - k]) / values[-1 - k] ** 0.5, values[-1 - k] / values.sum()) for at, (i, _) in enumerate(rows) for k in range(4)]
    same(got, want)
    assert got[0]["identity_error"] < 1e-9


def test_op13(spark, docs):
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    got = {r["doc_id"]: r for r in entry.queries()["op13_toxicity"](spark, SF).collect()}
    assert set(got) == {d for d, _, _ in docs}
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [d for d in toxic if got[d]["held_out"]]
    assert sum(got[d]["predicted"] == toxic[d] for d in held) >= 0.8 * len(held)


def test_pipeline(spark, docs):
    rows = entry.queries()["pipeline"](spark, SF).collect()
    assert 0 < len(rows) < len(docs) and all(r.round_trip for r in rows)
