"""Quality counts against a plain reading of their definitions, and the estimated rules."""

import random
import re

import pytest

from clickloom.llm import quality


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines, dups = [], 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dups += line in lines
            lines.append(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


TEXTS = [None, "", " \n\t ", "one", "a b c d e a b c d e", "x x x x x x x x", "l1\nl1\n\nl1 \n l1\r\n", "é\x1c\x85ü #$ <b> |", "  a"]


def test_counts(rows):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices(["a ", "b ", "cc ", "\n", "é#"], k=rng.randint(0, 120))) for _ in range(60)] + ["same text"] * 2
    df = rows([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    out = {r.doc_id: r for r in quality.judge_quality(df).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_empty_table(rows):
    assert quality.judge_quality(rows([], "doc_id long, text string")).count() == 0


def test_estimated_rules_match_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality.judge_quality(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    labelled = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in labelled)
    assert right >= 0.97 * len(labelled)


def test_expectation_maximisation_finds_the_noisy_rule():
    rng = random.Random(5)
    counts = {}
    for _ in range(4000):
        good = rng.random() < 0.8
        votes = "".join(("g" if good else "b") if rng.random() < (0.55 if j == 2 else 0.9) else ("b" if good else "g") for j in range(8))
        counts[votes] = counts.get(votes, 0) + 1
    prior, chance, posterior = quality.fit(sorted(counts.items()))
    right = [(chance[j, 1, 1] + chance[j, 0, 0]) / 2 for j in range(8)]
    assert prior == pytest.approx(0.8, abs=0.03)
    assert right[2] < 0.62 and min(right[:2] + right[3:]) > 0.86
    assert posterior["g" * 8] > 0.99 > 0.01 > posterior["b" * 8]
