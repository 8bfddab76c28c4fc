"""Quality rules as weak supervision.

Each rule votes good, bad or abstains on a whole text. Texts with equal votes form a pattern; expectation
maximisation over the counted patterns (at most 3 to the number of rules) estimates how often each rule is
right and how many texts are good, without labels. A text is kept when the base rules pass and its posterior
probability of being good is at least one half.

Null texts count as empty: no words, base rules failed. Repeated rows get equal results. Columns that bear
the name of a result are replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.texts import SHINGLE_WORDS, add_columns, strings
from clickloom.session import materialise

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
GOOD, BAD, ABSTAIN = "g", "b", "-"
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def vote(x: float, good: tuple[float, float], bad: tuple[float, float]) -> str:
    """Good inside the closed range ``good``, bad outside the closed range ``bad``, else abstain."""
    return GOOD if good[0] <= x <= good[1] else BAD if x < bad[0] or x > bad[1] else ABSTAIN


INF = float("inf")
# Rule: measure, range that is good, range outside of which it is bad.
RULES = {
    "length": ((50, INF), (10, INF)),
    "word_length": ((3, 9), (2.2, 12)),
    "symbols": ((0, 0.02), (0, 0.1)),
    "dup_lines": ((0, 0.05), (0, 0.3)),
    "repeats": ((0, 0.02), (0, 0.2)),
    "wordlike": ((0.9, 1), (0.7, 1)),
    "line_ends": ((0.7, 1), (0.15, 1)),
    "digits": ((0, 0.02), (0, 0.15)),
}
_DIGITS = "0123456789"


def measure(text: str) -> tuple[int, int, int, int, int, str]:
    """The five base counts of a text and the votes of the rules, one letter each."""
    words = text.encode().split()  # bytes split on exactly the six ASCII blanks
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dups = len(lines) - len(set(lines))
    windows = list(zip(*(words[k:] for k in range(SHINGLE_WORDS))))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        until = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + SHINGLE_WORDS - max(i, until)
                until = i + SHINGLE_WORDS
    few = max(n, 1)
    measures = {
        "length": n,
        "word_length": chars / few,
        "symbols": symbols / few,
        "dup_lines": dups / max(len(lines), 1),
        "repeats": repeated / few,
        "wordlike": sum(w.strip(b".,;:!?\"'()").isalpha() or max(w) > 127 for w in words) / few,
        "line_ends": sum(x.rstrip(BLANKS)[-1] in ".!?:;\"'" for x in lines) / max(len(lines), 1),
        "digits": sum(map(text.count, _DIGITS)) / max(chars, 1),
    }
    return n, chars, symbols, dups, repeated, "".join(vote(measures[k], *RULES[k]) for k in RULES)


def measure_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts and ``votes``."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = list(zip(*map(measure, strings(batch.column(text))))) or [()] * 6
        names = [c.split()[0] for c in COUNTS.split(", ")]
        return {n: pa.array(v, pa.int64()) for n, v in zip(names, found)} | {"votes": pa.array(found[5], pa.string())}

    return add_columns(df, make, f"{COUNTS}, votes string")


def fit(patterns: list[tuple[str, int]], rounds: int = 200, tolerance: float = 1e-9) -> tuple[float, np.ndarray, dict[str, float]]:
    """(share of good texts, per rule the chances of good, bad and no vote for bad and good texts, posterior of
    each pattern) by expectation maximisation.

    The rules start as right more often than wrong, which settles which of the two classes is the good one. One
    count of each vote and class is added, so that unseen votes keep a chance.
    """
    if not patterns:
        return 0.5, np.zeros((len(RULES), 2, 3)), {}
    votes = np.array([["bg-".index(v) for v in p] for p, _ in patterns])
    counts = np.array([c for _, c in patterns], float)
    onehot = np.eye(3)[votes]
    prior = 0.7
    chance = np.tile(np.array([[0.5, 0.2, 0.3], [0.1, 0.6, 0.3]]), (votes.shape[1], 1, 1))
    before = -np.inf
    for _ in range(rounds):
        score = np.einsum("pjv,jcv->pc", onehot, np.log(chance)) + np.log([1 - prior, prior])
        top = score.max(1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(score - top).sum(1))
        posterior = np.exp(score - total[:, None])
        weight = posterior * counts[:, None]
        prior = (weight[:, 1].sum() + 1) / (counts.sum() + 2)
        chance = np.einsum("pc,pjv->jcv", weight, onehot) + 1
        chance /= chance.sum(2, keepdims=True)
        likelihood = float((total * counts).sum())
        if likelihood - before < tolerance * abs(likelihood):
            break
        before = likelihood
    return prior, chance, {p: float(q) for (p, _), q in zip(patterns, posterior[:, 1])}


def judge_quality(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with the base counts, ``votes``, ``posterior``, ``base_failed`` and ``kept``."""
    spark = df.sparkSession
    measured = materialise(measure_texts(df, text).drop(text))
    # At most 3^8 patterns, whatever the number of texts.
    patterns = [(r["votes"], r["n"]) for r in measured.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    _, _, posterior = fit(sorted(patterns))
    known = spark.createDataFrame(list(posterior.items()), "votes string, posterior double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        measured.drop("posterior", "base_failed", "kept")
        .join(F.broadcast(known), "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
    )
