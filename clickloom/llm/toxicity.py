"""Toxic spans by a linear-chain conditional random field, and a toxicity score for each document.

Labels say whether a document is toxic. Words (runs of letters) and their beginnings that occur in far more of the
toxic than of the other labelled documents mark tokens; in toxic documents those tokens are the toxic ones, all
others are clean. A field with the tags clean and toxic over the words of a text is fitted to these tags: a weight
for each mark, and weights for passing from tag to tag. Its forward and backward sums give the probability that a
token is toxic. What they add up to in a document, their density and their maximum then give the document's score,
by a logistic function fitted to the labels. So a mark that clean documents have by chance now and then condemns
nobody.

Tokens with a mark and their neighbours are tagged. A run of other words between them is one factor of the chain,
the power of one matrix, so the sums are those of the whole text however long it is, and no text is cut. Only in
fitting, a run of over ``APART`` such words counts as the end of a chain.

The model is fitted to some ``SAMPLE`` labelled documents of either class (all, where there are no more), those
whose ids have a hash below a limit; the shares of the classes are counted over all labels. It holds at most
``MARKS`` marks.

Defined cases. A null text counts as empty; an empty text and one without marks have the score of no evidence and
no spans. Label rows without a value are not used; of several labels of one id the highest counts, of
several labelled texts with one id the first in order. Without labels of both classes there are no marks, and all
documents have the share of toxic labels (one half without any) as their score. Repeated rows are scored alike. Further columns stay;
those that bear the name of a new one give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.texts import add_columns, mix, name_spans, pieces, prefix_sums
from clickloom.session import materialise, ship

SAMPLE = 4000
MARKS = 4096
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
LEAST_GAIN = 16.0  # log-likelihood ratio of a mark
LEAST_RATIO = 4.0  # how many times as often toxic documents have it
NEAR = 2
APART = 16
STEPS = 60
_WHOLE = np.uint64(0x5851F42D4C957F2D)


def fold_case(data: np.ndarray) -> np.ndarray:
    """Bytes with ASCII and Latin-1 letters in lower case, each where it was."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    out[second] += 0x20
    return out


def word_runs(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the runs of ASCII letters and non-ASCII characters but Latin-1 signs and general
    punctuation; none crosses texts. ``data`` is in lower case."""
    letter = (data >= 0x80) | ((data >= 97) & (data <= 122))
    for lead, width in ((0xC2, 2), (0xE2, 3)):
        at = np.flatnonzero(data == lead)
        if width == 3:
            at = at[(data[at + 1] >= 0x80) & (data[at + 1] <= 0x82)]
        for k in range(width):
            letter[at + k] = False
    before, after = np.concatenate([[False], letter[:-1]]), np.concatenate([letter[1:], [False]])
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    before[edge] = False
    after[edge - 1] = False
    start, end = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def marks_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, names) of the marks that words have: the whole word, and its beginnings."""
    sums = prefix_sums(data)
    yield np.arange(len(start)), name_spans(sums, start, end) ^ _WHOLE
    for length in BEGINNINGS:
        long = np.flatnonzero(end - start >= length)
        yield long, name_spans(sums, start[long], start[long] + length)


@dataclass(frozen=True)
class Model:
    """Names of marks, sorted, with their weights; ``shift``: the weights of the toxic tag at any token, and of
    passing from clean to toxic, toxic to clean and toxic to toxic; ``score``: of the document's score."""

    names: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    score: np.ndarray


@dataclass(frozen=True)
class Chains:
    """Tagged tokens of texts, text by text: ``first`` token of each text, evidence (``mark`` at ``token``), untagged
    words before each token and after the last one of a text; ``words`` of each text; byte spans of the tokens."""

    first: np.ndarray
    gap: np.ndarray
    tail: np.ndarray
    words: np.ndarray
    token: np.ndarray
    mark: np.ndarray
    start: np.ndarray
    end: np.ndarray


def chains_of(offsets: np.ndarray, data: np.ndarray, names: np.ndarray) -> Chains:
    data, texts = fold_case(data), len(offsets) - 1
    start, end, text = word_runs(offsets, data)
    words = np.bincount(text, minlength=texts)
    found_word, found_mark = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(names) and len(start):
        likely = np.zeros(1 << 16, bool)
        likely[(names & np.uint64(0xFFFF)).astype(np.int64)] = True
        for word, name in marks_of(data, start, end):
            some = np.flatnonzero(likely[(name & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.searchsorted(names, name[some]).clip(max=len(names) - 1)
            hit = names[at] == name[some]
            found_word.append(word[some[hit]])
            found_mark.append(at[hit])
    word, mark = np.concatenate(found_word), np.concatenate(found_mark)
    near = (word[:, None] + np.arange(-NEAR, NEAR + 1)).ravel()
    owner = np.repeat(text[word], 2 * NEAR + 1) if len(word) else near
    inside = (near >= 0) & (near < len(start))
    near, owner = near[inside], owner[inside]
    tagged = np.unique(near[text[near] == owner]) if len(near) else near
    first = np.searchsorted(text[tagged] if len(tagged) else tagged, np.arange(texts + 1))
    order = np.lexsort((mark, word))
    word, mark = word[order], mark[order]
    head = np.concatenate([[0], np.cumsum(words)])
    some = np.flatnonzero(np.diff(first))
    gap = np.diff(tagged, prepend=-1) - 1
    gap[first[some]] = tagged[first[some]] - head[some]
    tail = words.copy()
    tail[some] = head[some + 1] - 1 - tagged[first[some + 1] - 1]
    return Chains(first, gap, tail, words, np.searchsorted(tagged, word), mark, start[tagged], end[tagged])


def _steps(shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The factor of passing to a token, and that with the token's weight: rows from clean, toxic."""
    passing = np.exp(np.array([[0.0, shift[1]], [shift[2], shift[3]]]))
    return passing, passing * np.exp([0.0, shift[0]])


def _runs(step: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``step``, each divided by a power of its largest eigenvalue, and the logarithms of these."""
    half, turn = (step[0, 0] + step[1, 1]) / 2, (step[0, 0] - step[1, 1]) / 2
    root = np.sqrt(turn * turn + step[0, 1] * step[1, 0])
    large, small = half + root, half - root
    share = np.power(small / large, gap)[:, None, None]
    return ((step - small * np.eye(2)) - share * (step - large * np.eye(2))) / (large - small), gap * np.log(large)


def sums(chains: Chains, evidence: np.ndarray, shift: np.ndarray, back: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the sum over all taggings of each text, and the probability that a token is toxic."""
    texts, tokens = len(chains.first) - 1, len(chains.gap)
    passing, step = _steps(shift)
    power, scale = _runs(step, chains.gap)
    factor = power @ passing
    factor[:, :, 1] *= np.exp(evidence + shift[0])[:, None]
    end_power, end_scale = _runs(step, chains.tail)
    size = np.diff(chains.first)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), "left")  # texts longer than t
    forward, total = np.zeros((tokens, 2)), end_scale.copy()
    total += np.bincount(np.repeat(np.arange(texts), size), scale, texts)
    state = np.tile([1.0, 0.0], (texts, 1))
    for t, m in enumerate(active):
        own = order[:m]
        at = chains.first[own] + t
        state[own] = np.einsum("ni,nij->nj", state[own], factor[at])
        norm = state[own].sum(1)
        state[own] /= norm[:, None]
        total[own] += np.log(norm)
        forward[at] = state[own]
    total += np.log(np.einsum("ni,nij->n", state, end_power))
    if not back:
        return total, np.zeros(0)
    state, after = end_power.sum(2), np.zeros((tokens, 2))
    for t in range(len(active) - 1, -1, -1):
        own = order[: active[t]]
        at = chains.first[own] + t
        after[at] = state[own]
        state[own] = np.einsum("nij,nj->ni", factor[at], state[own])
        state[own] /= state[own].sum(1)[:, None]
    both = forward * after
    return total, both[:, 1] / both.sum(1)


def evidence_of(chains: Chains, weights: np.ndarray) -> np.ndarray:
    return np.bincount(chains.token, weights[chains.mark], len(chains.gap))


def path_counts(chains: Chains, tags: np.ndarray) -> np.ndarray:
    """How often the given tagging uses each weight of ``shift``; untagged words are clean."""
    texts, size = len(chains.first) - 1, np.diff(chains.first)
    opens = np.zeros(len(tags), bool)
    opens[chains.first[:-1][size > 0]] = True
    last = np.zeros(len(tags), bool)
    last[chains.first[1:][size > 0] - 1] = True
    before = np.concatenate([[False], tags[:-1]]) & ~opens
    apart = chains.gap > 0
    leaving = (before & apart).sum() + (tags & last & (np.repeat(chains.tail, size) > 0)).sum()
    return np.array([tags.sum(), (tags & (apart | ~before)).sum(), leaving + (before & ~apart & ~tags).sum(), (tags & before & ~apart).sum()], float)


def cut(chains: Chains, toxic: np.ndarray) -> tuple[Chains, np.ndarray]:
    """The chains cut at runs of over ``APART`` untagged words, which then open a chain, and the labels of the parts."""
    size = np.diff(chains.first)
    opens = chains.gap > APART
    opens[chains.first[:-1][size > 0]] = True
    start = np.flatnonzero(opens)
    text = np.repeat(np.arange(len(size)), size)[start]
    ends = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    return Chains(np.append(start, len(chains.gap)), chains.gap, np.where(ends, chains.tail[text], 0), chains.words[text], chains.token, chains.mark, chains.start, chains.end), toxic[text]


def fit_field(chains: Chains, toxic: np.ndarray, marks: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the marks and of ``shift``: greatest likelihood of the tags, with a quadratic penalty."""
    chains, toxic = cut(chains, toxic)
    tags = np.repeat(toxic, np.diff(chains.first))
    marked = np.zeros(len(tags), bool)
    marked[chains.token] = True
    tags &= marked
    seen, path = np.bincount(chains.mark, tags[chains.token], marks), path_counts(chains, tags)
    x = np.concatenate([np.zeros(marks), [-3.0, -1.0, 0.0, 0.0]])
    mean, square, small = np.zeros_like(x), np.zeros_like(x), 1e-4
    for k in range(1, STEPS + 1):
        weights, shift = x[:marks], x[marks:]
        evidence = evidence_of(chains, weights)
        total, probability = sums(chains, evidence, shift)
        slope = np.concatenate([seen - np.bincount(chains.mark, probability[chains.token], marks), path])
        for j in range(4):  # only four weights act on all tokens: differences do
            moved = shift.copy()
            moved[j] += small
            slope[marks + j] -= (sums(chains, evidence, moved, back=False)[0] - total).sum() / small
        slope -= np.concatenate([weights, 0.1 * shift])
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        x = x + 0.25 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-9)
    return x[:marks], x[marks:]


def summaries(chains: Chains, probability: np.ndarray) -> np.ndarray:
    """What a document's score is made of: a constant, the toxic tokens expected, their density, their maximum."""
    texts, size = len(chains.first) - 1, np.diff(chains.first)
    text = np.repeat(np.arange(texts), size)
    expected, most = np.bincount(text, probability, texts), np.zeros(texts)
    np.maximum.at(most, text, probability)
    return np.stack([np.ones(texts), np.log1p(expected), np.log((expected + 0.05) / (chains.words + 20)), most], 1)


def fit_score(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a slight penalty."""
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - 0.01 * c
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(c))
        step = np.linalg.solve(bend, slope)
        c = c + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return c


def count_marks(sample: DataFrame) -> DataFrame:
    """``name, toxic, other``: in how many texts of the sample (``text, toxic``) a mark occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist(), bool)
            for first, offsets, data in pieces(batch.column("text")):
                data = fold_case(data)
                start, end, text = word_runs(offsets, data)
                found = [np.stack([text[word].astype(np.uint64), name]) for word, name in marks_of(data, start, end)]
                text, name = np.unique(np.concatenate(found, 1), axis=1)
                names, at = np.unique(name, return_inverse=True)
                bad = np.bincount(at, toxic[first + text.astype(np.int64)], len(names)).astype(np.int64)
                columns = [names.view(np.int64), bad, np.bincount(at, minlength=len(names)) - bad]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["name", "toxic", "other"])

    parts = sample.select("text", "toxic").mapInArrow(run, "name bigint, toxic bigint, other bigint")
    return parts.groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def pick_marks(counts: DataFrame, toxic: int, other: int) -> np.ndarray:
    """Names of the marks that tell toxic texts best, sorted."""

    def gain(n, total):
        share = (F.col("toxic") + F.col("other")) / F.lit(float(toxic + other))
        n, total = n.cast("double"), F.lit(float(total))
        inside = F.when(n > 0, n * F.log(n / (total * share))).otherwise(0.0)
        return inside + F.when(n < total, (total - n) * F.log((total - n) / (total * (1 - share)))).otherwise(0.0)

    ratio = ((F.col("toxic") + 0.5) / (toxic + 1.0)) / ((F.col("other") + 0.5) / (other + 1.0))
    partly = F.col("toxic") + F.col("other") < toxic + other
    judged = counts.where(partly & (ratio >= LEAST_RATIO)).withColumn("gain", 2 * (gain(F.col("toxic"), toxic) + gain(F.col("other"), other)))
    best = judged.where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "name").limit(MARKS).select("name").collect()
    return np.sort(np.array([r["name"] for r in best], np.int64).view(np.uint64))


def _joined(parts: list[Chains]) -> Chains:
    """Chains of several groups of texts as one; the byte spans keep their own origin."""
    tokens = np.cumsum([0, *(len(p.gap) for p in parts)])
    first = np.concatenate([[0], *(p.first[1:] + n for p, n in zip(parts, tokens))])
    token = np.concatenate([p.token + n for p, n in zip(parts, tokens)])
    return Chains(first.astype(np.int64), *(np.concatenate([getattr(p, f) for p in parts]) for f in ("gap", "tail", "words")), token, *(np.concatenate([getattr(p, f) for p in parts]) for f in ("mark", "start", "end")))


def _collect_chains(sample: DataFrame, names: np.ndarray) -> tuple[Chains, np.ndarray]:
    """Tagged tokens of the sampled texts, and which texts are toxic."""
    fields = ("first", "gap", "tail", "words", "token", "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist(), bool)
            for first, offsets, data in pieces(batch.column("text")):
                chains = chains_of(offsets, data, names)
                cells = [pa.array([np.asarray(getattr(chains, f), np.int64)], pa.list_(pa.int64())) for f in fields]
                cells.append(pa.array([toxic[first : first + len(offsets) - 1].astype(np.int64)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cells, names=[*fields, "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(run, ", ".join(f"{f} array<bigint>" for f in (*fields, "toxic"))).collect()
    none = np.zeros(0, np.int64)
    parts = [Chains(*(np.array(r[f], np.int64) for f in fields), none, none) for r in rows]
    return _joined(parts), np.concatenate([np.array(r["toxic"], bool) for r in rows])


def _share(sample: int, count: int) -> int:
    """The limit of hashes in 32 bits below which some ``sample`` of ``count`` ids lie."""
    return 1 << 32 if count <= sample else (sample << 32) // count


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from the documents that ``labels`` (``doc_id`` and a label, toxic if above 0) marks."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(label) > 0).alias("toxic"))
    known = materialise(marked.join(docs.select("doc_id"), "doc_id", "left_semi"))
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = count.get(True, 0), count.get(False, 0)
    none = np.zeros(0)
    share = np.clip((bad + 0.5) / (bad + good + 1.0), 1e-6, 1 - 1e-6)
    prior = Model(none.astype(np.uint64), none, np.zeros(4), np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0]))
    if not bad or not good:
        return prior
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    limit = F.when(F.col("toxic"), _share(sample, bad)).otherwise(_share(sample, good))
    chosen = materialise(known.where(place < limit))
    taken = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad_taken, good_taken = taken.get(True, 0), taken.get(False, 0)
    if not bad_taken or not good_taken:
        return prior
    few = bad_taken + good_taken <= 4 * sample  # nearly sure
    texts = docs.join(F.broadcast(chosen) if few else chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    texts = materialise(texts)
    names = pick_marks(count_marks(texts), bad_taken, good_taken)
    if not len(names):
        return prior
    chains, toxic = _collect_chains(texts, names)
    weights, shift = fit_field(chains, toxic, len(names))
    _, probability = sums(chains, evidence_of(chains, weights), shift)
    weight = np.where(toxic, bad / bad_taken, good / good_taken)
    return Model(names, weights, shift, fit_score(summaries(chains, probability), toxic, weight / weight.mean()))


def tag_texts(column: pa.Array, model: Model) -> tuple[np.ndarray, pa.Array]:
    """Score of each text, and its toxic tokens as (start, end, probability) in code points, end exclusive."""
    scores, sizes, flat_spans = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros((3, 0))]
    for _, offsets, data in pieces(column):
        chains = chains_of(offsets, data, model.names)
        _, probability = sums(chains, evidence_of(chains, model.weights), model.shift)
        # Column by column, so that equal texts have equal scores whatever batch they are in.
        logit = sum(x * c for x, c in zip(summaries(chains, probability).T, model.score))
        scores.append(1 / (1 + np.exp(-np.clip(logit, -700, 700))))
        bad = np.flatnonzero(probability >= 0.5)
        text = np.searchsorted(chains.first, bad, "right") - 1
        sizes.append(np.bincount(text, minlength=len(offsets) - 1))
        if len(bad):
            before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            origin = before[offsets[text]]
            flat_spans.append(np.stack([before[chains.start[bad]] - origin, before[chains.end[bad]] - origin, probability[bad]]))
    start, end, probability = np.concatenate(flat_spans, 1)
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(probability)], names=["start", "end", "probability"])
    return np.concatenate(scores), pa.ListArray.from_arrays(pa.array(ends), spans)


def tag(docs: DataFrame, model: Model, text: str = "text", score: str = "score", spans: str = "spans") -> DataFrame:
    """``docs`` with the score (0 to 1) and the toxic spans of each text."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        values, found = tag_texts(batch.column(text), model)
        return {score: pa.array(values), spans: found}

    return add_columns(docs, make, f"{score} double, {spans} array<struct<start:int,end:int,probability:double>>")
