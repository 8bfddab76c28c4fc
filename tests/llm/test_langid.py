"""Language filters: n-grams against a plain reading, held-out accuracy, odd input."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string"


def plain(text):
    words = ["".join(g) for g in re.findall(r"[^\W\d_]+", text.lower())]
    return Counter(f" {w} "[i : i + 4] for w in words for i in range(len(w) - 1))


def name(gram):
    out = 0
    for i, c in enumerate(gram):
        code = 0 if c == " " else ord(c)
        out = code if i == 0 else (out * int(langid._BASE) + code) % 2**64
    return out


def test_grams_are_those_of_words():
    texts = ["That it.", "", "a I 12 x", "ÉÉ-tude, naïve\n\nword's 你好吗 🙂 end", "zz9zzzz", "."]
    text, names, some = langid.grams(texts)
    for i, t in enumerate(texts):
        assert Counter(names[text == i].tolist()) == {name(g): n for g, n in plain(t).items()}
        assert some[i] == any(c.isalpha() for c in t)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    letters = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "éèçàabmn"}
    data = []
    for i in range(300):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choices(letters[lang], k=rng.randint(1, 7))) for _ in range(rng.randint(2, 80)))
        data.append((i, text, lang if i % 5 else None, "x"))
    return data


def test_held_out_accuracy(spark, labelled):
    df = spark.createDataFrame(labelled, SCHEMA)
    filters = langid.train(df.where("doc_id < 200"))
    assert set(filters.languages) == {"aa", "bb", "cc"}
    got = langid.identify(df.where("doc_id >= 200"), filters).where("lang is not null").collect()
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_odd_texts(spark, labelled):
    filters = langid.train(spark.createDataFrame(labelled, SCHEMA))
    texts = [None, "", " 12 ?\n", "x", "abcde " * 60_000, "abcde", "abcde"]
    got = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), filters).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert got[3].lang_pred == filters.languages[0] and got[3].score == 0
    assert {r.lang_pred for r in got[4:]} == {"aa"}


def test_nothing_learned_and_empty_tables(spark):
    empty = spark.createDataFrame([(1, "text", None, "")], SCHEMA)
    filters = langid.train(empty)
    assert filters.languages == []
    assert [(r.lang_pred, r.score) for r in langid.identify(empty, filters).collect()] == [("und", 0.0)]
    assert langid.identify(empty.limit(0), filters).count() == 0


def test_many_languages(spark):
    data = [(i, " ".join(chr(0x4E00 + 60 * i + k % 50) * 3 for k in range(200)), f"l{i:03}") for i in range(130)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    filters = langid.train(df)
    assert filters.table.shape[1] == 3 and np.all(filters.false < 0.01)
    assert all(r.lang == r.lang_pred for r in langid.identify(df, filters).collect())
