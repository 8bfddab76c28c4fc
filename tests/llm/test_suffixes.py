"""Removal of repeated byte strings against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, strategies as st

from clickloom.llm import suffixes


def brute(data, length):
    texts = [(d, (t or "").encode()) for d, t in data]
    first = {}
    for d, b in texts:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, (1, 0)), (d is None, d or 0))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d is None, d or 0):
                gone[i : i + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        out.append((d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def order(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize(("length", "letters"), [(6, "ab"), (7, "abé "), (1, "abcde"), (50, "ab")])
def test_brute_force(rows, length, letters):
    rng = random.Random(length)
    data = [(-5, None), (3, ""), (4, "x"), (None, "ab" * 40), (None, "abé abab")]
    for d in range(60):
        text = "".join(rng.choices(letters, k=rng.randint(0, 40)))
        if d % 3:
            text += rng.choice(data)[1] or ""
        if d % 7 == 0:
            text = text[: len(text) // 2] + "ba" * 40 + text
        data.append((d * 7 - 100, text))
    data += [data[9], data[9], (data[12][0], data[20][1]), (10**12, "zq" * 3000 + data[30][1] + "b" * 500)]
    df = rows([(d, t, 5, "y") for d, t in data], "doc_id long, text string, kept int, src string")
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df, length).collect()]
    assert sorted(got, key=order) == sorted(brute(data, length), key=order)


def test_empty_table(rows):
    assert suffixes.remove_repeats(rows([], "doc_id long, text string")).count() == 0


def test_texts_are_shuffled_once(rows):
    result = suffixes.remove_repeats(rows([(1, "a" * 100), (2, "a" * 90)], "doc_id long, text string"))
    assert {(r.doc_id, r.n_removed) for r in result.collect()} == {(1, 0), (2, 90)}
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 3


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 300), st.integers(5, 5)), max_size=40))
def test_packed_columns_come_back(entries):
    entries.sort()
    columns = [np.array([e[i] for e in entries], np.uint64) for i in range(3)]
    for got, want in zip(suffixes.unpack(suffixes.pack(*columns)), columns):
        assert (got == want).all()
