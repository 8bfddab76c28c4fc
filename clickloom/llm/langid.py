"""Language identification with language-bitmask n-gram filters.

Training counts the n-grams of letters of every labelled text and keeps, per language, those that make up at
least ``SHARE`` of its n-grams: at most 1 / SHARE of them, however large the corpus. They fill bit-sliced
Bloom filters: one array of slots for all languages, each slot a bitmask of the languages that set it. The
conjunction of an n-gram's slots is the set of languages that have it. A text's n-grams are counted for every
language, the counts corrected for the filters' false positives, and the largest count decides.

An n-gram lies within one word; the word's ends count as letters. Letters are lower-cased. Ties go to the
language with more training text, then to the smaller name. Null texts and texts without a letter are
``und`` with score 0, as is every text when nothing was learned. A text with letters but without an n-gram
gets the language with most training text, with score 0. Rows whose language is null do not train.
More than ``LANGUAGES`` different languages are refused with an error: the filters take 4 MB for 64 of them.

The cut at ``SHARE`` lowers scores, the more the richer a language is. So whether a text is ``foreign``, in no
learned language, is told by what share of a language's own training n-grams passed the cut (``reach``): its
score must be less than ``LEAST`` of that, on so many n-grams that chance would do it to a text of the language
once in ``e**EVIDENCE`` times. A text with fewer n-grams is undecided and not foreign; one without a letter is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.texts import add_columns, mix, parts, strings
from clickloom.session import materialise, ship

LETTERS = 4
SHARE = 2e-5
HASHES = 3
SLOT_BITS = 19
LANGUAGES = 1024
CHUNK = 1 << 18
UNKNOWN = "und"
LEAST = 0.2
EVIDENCE = 14
# Even where no n-gram was cut, new text of a language has others than its training text.
MOST_REACH = 0.9
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ALPHA: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For each code point whether it is a letter; made once per worker."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, name) of each n-gram, and whether each text has a letter."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in low])
    text = np.concatenate([text[:1], text])[: len(codes)] if len(texts) else np.zeros(0, np.int32)
    letter = is_letter()[codes]
    # One zero stands for every run of other characters.
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1]
    some = np.zeros(len(texts), bool)
    some[text[letter]] = True
    codes, letter, text = np.where(letter, codes, 0)[kept].astype(np.uint64), letter[kept], text[kept]
    n = len(codes) - LETTERS + 1
    if n < 1:
        return np.zeros(0, np.int32), np.zeros(0, np.uint64), some
    name, inside = codes[:n].copy(), np.ones(n, bool)
    for k in range(1, LETTERS):
        name = name * _BASE + codes[k : k + n]
        if k < LETTERS - 1:
            inside &= letter[k : k + n]
    return text[1 : n + 1][inside], name[inside], some


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about ``CHUNK`` characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def count_grams(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, n`` over all rows with a language."""
    ship(df.sparkSession)
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts(whole)):
            by: dict[str, list[str]] = {}
            for lang_, text_ in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by.setdefault(lang_, []).append(text_)
            for lang_, texts in by.items():
                names, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for _, chunk in chunks(texts):
                    name, count = np.unique(grams(chunk)[1], return_counts=True)
                    names.append(name)
                    counts.append(count)
                name, at = np.unique(np.concatenate(names), return_inverse=True)
                count = np.bincount(at, np.concatenate(counts), len(name)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang_] * len(name), pa.string()), pa.array(name.view(np.int64)), pa.array(count)], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slots(name: np.ndarray) -> Iterator[np.ndarray]:
    h = mix(name.copy())
    for k in range(HASHES):
        yield (h >> np.uint64(64 - (k + 1) * (64 // HASHES))) & np.uint64((1 << SLOT_BITS) - 1)


@dataclass(frozen=True)
class Filters:
    """Languages, ordered by training text; ``table`` holds a bitmask of 64 languages per slot and word; ``false`` the chance of a false hit;
    ``reach`` the share of the training n-grams of a language that are in its filter."""

    languages: list[str]
    table: np.ndarray
    false: np.ndarray
    reach: np.ndarray


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """The filters of all languages in ``df``. What reaches the driver is bounded by the number of slots and languages."""
    counted = materialise(count_grams(df, text, lang))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n")).limit(LANGUAGES + 1).collect()
    if len(totals) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    totals = sorted(totals, key=lambda r: (-r["n"], r["lang"]))
    languages = [r["lang"] for r in totals]
    table = np.zeros((1 << SLOT_BITS, max(1, -(-len(languages) // 64))), np.uint64)
    reach = np.zeros(len(languages))
    if languages:
        least = F.create_map(*[F.lit(x) for r in totals for x in (r["lang"], r["n"] * SHARE)])
        number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
        chosen = counted.where(F.col("n") >= least[F.col("lang")]).select("gram", "n", number[F.col("lang")].alias("number"))
        for r in chosen.groupBy("number").agg(F.sum("n").alias("n")).collect():
            reach[r["number"]] = r["n"] / totals[r["number"]]["n"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                number_ = batch.column("number").to_numpy().astype(np.uint64)
                bits = (np.uint64(1) << (number_ % np.uint64(64))).view(np.int64)
                for slot in slots(batch.column("gram").to_numpy().view(np.uint64)):
                    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array((number_ // np.uint64(64)).astype(np.int64)), pa.array(bits)], names=["slot", "word", "bits"])

        filled = chosen.select("gram", "number").mapInArrow(run, "slot bigint, word bigint, bits bigint").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table[filled["slot"].to_numpy(), filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    fill = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return Filters(languages, table, fill**HASHES, reach)


def is_foreign(score: np.ndarray, n: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Whether ``n`` n-grams of which a share of ``score`` are in the filter are too few hits for a language of this reach."""
    want = np.clip(reach, 1e-9, MOST_REACH)
    got = np.clip(score, 1e-12, 1 - 1e-12)
    # The chance of no more hits is at most exp(-n * divergence).
    divergence = got * np.log(got / want) + (1 - got) * np.log((1 - got) / (1 - want))
    return (score < LEAST * reach) & (n * divergence >= EVIDENCE)


def identify(df: DataFrame, filters: Filters, text: str = "text", lang_pred: str = "lang_pred", score: str = "score", foreign: str | None = None) -> DataFrame:
    """``df`` with the language of each whole text and, as score, the share of its n-grams that the language has;
    on demand also whether it is in no learned language."""
    sent = df.sparkSession.sparkContext.broadcast(filters)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        f = sent.value
        names, scores, outside = [], [], [np.zeros(0, bool)]
        for _, chunk in chunks(strings(batch.column(text))):
            doc, name, some = grams(chunk)
            n = np.bincount(doc, minlength=len(chunk))
            hits = np.zeros((len(f.languages), len(chunk)))
            at = list(slots(name))
            for word in range(f.table.shape[1]):
                column = f.table[:, word]
                mask = column[at[0]]
                for slot in at[1:]:
                    mask &= column[slot]
                for i in range(64 * word, min(64 * word + 64, len(f.languages))):
                    hits[i] = np.bincount(doc[(mask >> np.uint64(i % 64)) & np.uint64(1) == 1], minlength=len(chunk))
            true = np.clip((hits - n * f.false[:, None]) / (1 - np.minimum(f.false[:, None], 0.999)), 0, n)
            best = true.argmax(0) if len(f.languages) else np.zeros(len(chunk), int)
            for row in range(len(chunk)):
                known = some[row] and len(f.languages)
                names.append(f.languages[best[row]] if known else UNKNOWN)
                scores.append(float(true[best[row], row] / n[row]) if known and n[row] else 0.0)
            if foreign and len(f.languages):
                outside.append(~some | is_foreign(np.array(scores[-len(chunk) :]), n, f.reach[best]))
            elif foreign:
                outside.append(np.ones(len(chunk), bool))
        made = {lang_pred: pa.array(names, pa.string()), score: pa.array(scores, pa.float64())}
        return made | ({foreign: pa.array(np.concatenate(outside))} if foreign else {})

    return add_columns(df, make, f"{lang_pred} string, {score} double" + (f", {foreign} boolean" if foreign else ""))
