"""Containment search against brute force, and odd input."""

import random
import re

import pytest

from clickloom.llm import decontaminate


def grams(text):
    w = [x for x in re.split("[ \t-\r]+", text or "") if x]
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items, threshold):
    out = set()
    for i, item in items:
        want = grams(item)
        for d, text in docs:
            hit = len(want & grams(text))
            if want and hit >= threshold * len(want) - 1e-9:
                out.add((d, i, len(want), hit))
    return out


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_brute_force(rows, threshold, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 90)))) for i in range(40)] + [(99, None), (98, ""), (97, "a b c d e")]
    docs = [(1000, None), (1001, ""), (1002, "a b c d"), (1003, "x a  b\tc\nd e")]
    for d in range(150):
        body = rng.choices(words, k=rng.randint(0, 300))
        if d % 2:
            w = (items[rng.randrange(40)][1]).split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = w
        docs.append((d, " ".join(body)))
    docs += [docs[10], docs[11], (500, docs[11][1])]
    d = rows([(a, b, "clash", 1) for a, b in docs], "doc_id long, text string, item_id string, n_found int")
    i = rows([(a, b, 0) for a, b in items], "item_id long, text string, doc_id int")
    want = brute({*docs}, items, threshold)
    for limit in (500_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
        got = decontaminate.find_items(d, i, threshold).collect()
        assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got} == want
        assert len(got) == len(want)
    assert want


def test_long_document_null_id_and_empty_tables(rows):
    item = "one two three four five six seven"
    d = rows([(None, "x " * 200_000 + item), (2, "x")], "doc_id long, text string")
    i = rows([(7, item), (None, item)], "item_id long, text string")
    got = decontaminate.find_items(d, i).collect()
    assert {(r.doc_id, r.item_id, r.containment) for r in got} == {(None, 7, 1.0), (None, None, 1.0)}
    assert decontaminate.find_items(d.limit(0), i).count() == 0
    assert decontaminate.find_items(d, i.limit(0)).count() == 0
