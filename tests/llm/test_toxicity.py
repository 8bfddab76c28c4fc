import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import toxicity

LETTERS = re.compile(r"[^\W\d_]+")


def flat(texts):
    data = [t.encode() for t in texts]
    return np.cumsum([0, *map(len, data)]), np.frombuffer(b"".join(data), np.uint8)


def test_words_are_runs_of_letters():
    texts = ["Él dijo: no-no!", "", "A1b2 «c»—d… É", "x", "ßÄ über"]
    offsets, data = flat(texts)
    folded = toxicity.fold_case(data)
    start, end, text = toxicity.word_runs(offsets, folded)
    got = [(int(t), bytes(folded[a:b]).decode()) for a, b, t in zip(start, end, text)]
    assert got == [(i, w.lower()) for i, t in enumerate(texts) for w in LETTERS.findall(t)]


def plain_sums(evidence, tagged, n, shift):
    """Sum over all taggings of one text and the tokens' probabilities, by enumeration."""
    total, toxic = 0.0, np.zeros(n)
    for tags in itertools.product((0, 1), repeat=n):
        score, before = 0.0, 0
        for t, now in enumerate(tags):
            score += {(0, 0): 0.0, (0, 1): shift[1], (1, 0): shift[2], (1, 1): shift[3]}[before, now] + now * (shift[0] + evidence.get(t, 0.0))
            before = now
        total += np.exp(score)
        toxic += np.exp(score) * np.array(tags)
    return np.log(total), toxic[tagged] / total


@pytest.mark.parametrize("seed", range(4))
def test_sums_match_enumeration(seed):
    random = np.random.default_rng(seed)
    words = ["w%s" % "abcdefghij"[i] for i in range(10)]
    texts = [" ".join(random.choice(words, random.integers(0, 11))) for _ in range(12)] + ["", "wa", "zz zz wb zz zz zz zz zz zz zz wa"]
    offsets, data = flat(texts)
    names = np.sort(next(toxicity.marks_of(*(lambda o, d: (d, *toxicity.word_runs(o, d)[:2]))(*flat(["wa wb"]))))[1])
    chains = toxicity.chains_of(offsets, data, names)
    weights, shift = random.standard_normal(2), random.standard_normal(4)
    total, probability = toxicity.sums(chains, toxicity.evidence_of(chains, weights), shift)
    order = {int(n): w for n, w in zip(names, weights)}
    weight = {w: order[int(next(toxicity.marks_of(*(lambda o, d: (d, *toxicity.word_runs(o, d)[:2]))(*flat([w]))))[1][0])] for w in ("wa", "wb")}
    for i, text in enumerate(texts):
        said = text.split()
        marked = [t for t, w in enumerate(said) if w in weight]
        tagged = sorted({t for m in marked for t in range(m - 2, m + 3) if 0 <= t < len(said)})
        assert chains.first[i + 1] - chains.first[i] == len(tagged)
        want, each = plain_sums({t: weight[said[t]] for t in marked}, tagged, len(said), shift)
        assert np.isclose(total[i], want) and np.allclose(probability[chains.first[i] : chains.first[i + 1]], each)


def corpus(n=240):
    random = np.random.default_rng(5)
    plain = ["".join(random.choice(list("aeiounrstl"), random.integers(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = list(random.choice(plain, random.integers(30, 120)))
        toxic = i % 6 == 0
        for _ in range(4 if toxic else i % 7 == 1):
            words[random.integers(len(words))] = random.choice(["Grumpf", "zorkelig", "zorkelhaft"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_finds_toxic_documents_and_spans(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    model = toxicity.train(frame, spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id bigint, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.tag(frame, model).collect()}
    right = [(got[i]["score"] >= 0.5) == bool(t) for i, t in labels if i % 5 == 0]
    assert sum(right) >= 0.95 * len(right)
    for i, text in docs:
        for s in got[i]["spans"]:
            assert text[s["start"] : s["end"]].lower() in ("grumpf", "zorkelig", "zorkelhaft") and 0.5 <= s["probability"] <= 1
    assert all(got[i]["spans"] for i, t in labels if t)


def test_odd_rows(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = toxicity.train(frame, spark.createDataFrame([*labels, (0, None), (None, 1), (999, 1)], "doc_id bigint, toxic int"))
    odd = [(None, None, 1.0, "k"), (1, "", 1.0, None), (1, "grumpf", 2.0, ""), (1, "grumpf", 2.0, ""), (2, "Über grumpf ü Grumpf", 0.0, ""), (3, "la li " * 100_000 + "Zorkelig", 0.0, "")]
    got = toxicity.tag(spark.createDataFrame(odd, "doc_id bigint, text string, score double, extra string"), model).collect()
    assert len(got) == len(odd) and got[0].asDict().keys() == {"doc_id", "text", "score", "extra", "spans"} and all(0 <= r["score"] <= 1 for r in got)
    none = [r["score"] for r in got if not r["text"]]
    assert none[0] == none[1] and len({r["score"] for r in got if r["text"] == "grumpf"}) == 1
    spans = next(r for r in got if r["doc_id"] == 2)["spans"]
    assert {(s["start"], s["end"]) for s in spans} <= {(5, 11), (14, 20)}
    assert toxicity.tag(spark.createDataFrame([], "doc_id bigint, text string"), model).collect() == []


def test_without_two_classes(spark):
    frame = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id bigint, text string")
    for given, low, high in (([], 0.5, 0.5), ([(1, 0)], 0.2, 0.3), ([(1, 1), (2, 1)], 0.8, 0.9)):
        model = toxicity.train(frame, spark.createDataFrame(given, "doc_id bigint, toxic int"))
        assert all(low <= r["score"] <= high and r["spans"] == [] for r in toxicity.tag(frame, model).collect())


def test_score_of_long_chain_is_finite():
    names = np.sort(next(toxicity.marks_of(*(lambda o, d: (d, *toxicity.word_runs(o, d)[:2]))(*flat(["bad"]))))[1])
    model = toxicity.Model(names, np.array([4.0]), np.array([-2.0, -1.0, 0.5, 0.5]), np.array([-3.0, 1.0, 0.1, 1.0]))
    scores, spans = toxicity.tag_texts(pa.array(["bad ok ok " * 20_000, None, "ok " * 100_000, "bad"]), model)
    assert np.isfinite(scores).all() and len(spans[0]) >= 20_000 and len(spans[1]) == 0 and scores[1] < 0.5 < scores[0]
