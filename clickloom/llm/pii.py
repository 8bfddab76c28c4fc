"""Personal data: base patterns, and a semi-Markov conditional random field that adds disguised forms.

The base patterns find e-mail addresses, IP addresses, card numbers and phone numbers as written plainly. The
field looks at the rest of the text, where numbers or words such as "(at)" and "dot" hint at the same kinds
written otherwise. It scores whole candidate spans of tokens by features of the span, and a dynamic program
over spans of at most ``LONGEST`` tokens chooses boundaries and kinds together. Spans that touch a base span
are no candidates, so base spans always stay.

The field is trained on the driver by conditional likelihood. Its examples are windows from at most
``SAMPLE`` documents, those with the smallest hash, into which plain, disguised and misleading strings made
by rule are put; the base patterns label the rest.

Null texts are empty and have no spans. Spans are code points, end exclusive, ordered by start, then kind.
Repeated rows get equal results. Columns that bear the name of a result are replaced.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.texts import add_columns, strings
from clickloom.session import ship

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 300
WINDOWS = 600
LONGEST = 32
SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"

Span = tuple[int, int, str]

# Possessive repeats and a look behind: none of these can match after giving a character back, or from inside a
# run of digits, so long runs take one pass.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, ordered by start, then kind as listed."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            out.append((start, free, "email"))
        at = text.find("@", max(at + 1, free))
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((*m.span(), "phone"))
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


# --- Candidate spans -------------------------------------------------------------------------------

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.S)
_NUMBERS = re.compile(r"[0-9 ().,/\[\]+_-]{7,}+")
_FIRST = re.compile(r"[0-9(+]")
_SIGNS = re.compile(r"[(\[{] ?(?:at|dot) ?[)\]}]| (?:dot|DOT) ")
_AT = re.compile(r"@|[(\[{] ?at ?[)\]}]| (?:at|AT) ")
_DOT = re.compile(r"\.|[(\[{] ?dot ?[)\]}]| (?:dot|DOT) ")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+(?: (?:dot|DOT) [A-Za-z0-9._%+-]+)*(?:@|[(\[{] ?at ?[)\]}]| (?:at|AT) | ?[(\[{]at[)\]}] ?)[A-Za-z0-9-]+(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| (?:dot|DOT) )[A-Za-z0-9-]+)+")
_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu".split())
_HINTS = {
    "email": re.compile(r"mail|contact|write|reach", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|pay", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|dial", re.I),
}
MARGIN = 64


def regions(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Stretches that may hold a candidate, free of base spans."""
    found = []
    for m in _NUMBERS.finditer(text):
        first = _FIRST.search(m[0])
        last = len(m[0].rstrip(" ().,/[]+_-"))
        if first and last - first.start() >= 7:
            found.append((m.start() + first.start(), m.start() + last))
    if any(x in text for x in ("at)", "at]", "at}", "dot", "DOT")):
        found += [(max(0, m.start() - MARGIN), m.end() + MARGIN) for m in _SIGNS.finditer(text)]
    if not found:
        return []
    found.sort()
    merged = [list(found[0])]
    for a, b in found[1:]:
        if a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, first = [], 0
    for a, b in merged:
        b = min(b, len(text))
        # Spans before `first` end before this stretch; later ones are ordered by their start.
        while first < len(taken) and taken[first][1] <= a:
            first += 1
        for s, e, _ in taken[first:]:
            if s >= b:
                break
            if s > a:
                out.append((a, s))
            a = max(a, e)
        if a < b:
            out.append((a, b))
    return out


def candidates(text: str, region: tuple[int, int]) -> tuple[list[int], list[tuple[int, int]]]:
    """Token boundaries of a region and candidate spans as pairs of boundary numbers."""
    bounds = [m.start() for m in _TOKEN.finditer(text, *region)] + [region[1]]
    tokens = [text[a:b] for a, b in zip(bounds, bounds[1:])]
    digits = np.cumsum([0] + [len(t) if t[0] in "0123456789" else 0 for t in tokens])
    signs = np.cumsum([0] + [t in ("@", "at", "AT") for t in tokens])
    letters = np.cumsum([0] + [t[0].isalpha() for t in tokens])
    spans = []
    for i, t in enumerate(tokens):
        if not (t[0].isalnum() or t in "+("):
            continue
        for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
            if not tokens[j - 1][0].isalnum():
                continue
            numbers = digits[j] - digits[i]
            if letters[j] == letters[i]:
                if numbers >= 7 and numbers <= 22 or 4 <= numbers <= 12 and j - i >= 7:
                    spans.append((i, j))
            elif signs[j] > signs[i] and t[0].isalnum() and j - i >= 5 and _ADDRESS.fullmatch(text, bounds[i], bounds[j]):
                spans.append((i, j))
    return bounds, spans


def describe(text: str, start: int, end: int) -> np.ndarray:
    """Features of a whole span and its surroundings."""
    s = text[start:end]
    numbers = re.findall("[0-9]+", s)
    n = sum(map(len, numbers))
    before, after = text[max(0, start - 24) : start], text[end : end + 2]
    seps = re.findall("[^0-9]+", s[1:]) if numbers else []
    words = re.findall("[A-Za-z]+", s)
    four = len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    lengths = [len(x) for x in numbers]
    at, alike = bool(_AT.search(s)), len(set(seps)) <= 1
    card = 12 <= n <= 19 and luhn("".join(numbers))
    return np.array(
        [
            1,
            at,
            at and bool(_DOT.search(s)),
            bool(words) and words[-1].lower() in _ENDINGS,
            not words,
            n < 7,
            7 <= n <= 8,
            9 <= n <= 11,
            12 <= n <= 15,
            n == 16,
            n > 16,
            card and not words,
            card and not words and alike and max(lengths, default=0) <= 6,
            four and alike and not words,
            four and not words and lengths == [4] * 4,
            len(numbers) == 1,
            2 <= len(numbers) <= 5 and min(lengths) >= 2 and not words,
            lengths in ([4, 2, 2], [2, 2, 4], [1, 2, 4], [2, 1, 4], [1, 1, 4]),
            "." in s and len(numbers) == 2,
            "," in s and all(x == 3 for x in lengths[1:]),
            "/" in s,
            s[0] in "+(",
            s[0] == "0",
            bool(numbers) and len(numbers[-1]) >= 4,
            "  " in s or "\n" in s,
            bool(before) and (before[-1].isalnum() or before[-1] in ".,/-@_$€"),
            bool(after) and (after[0].isalnum() or (after[0] in ".,/-@_%" and after[1:].isalnum())),
            *(bool(h.search(before)) for h in _HINTS.values()),
        ],
        float,
    )


FEATURES = len(describe("1", 0, 1))


@dataclass(frozen=True)
class Field:
    """Weights of the features for each kind; text outside of spans scores 0."""

    weights: np.ndarray

    def spans(self, text: str, taken: list[Span]) -> list[Span]:
        """The best segmentation of each region that base spans leave free."""
        out: list[Span] = []
        for region in regions(text, taken):
            bounds, spans = candidates(text, region)
            if not spans:
                continue
            scores = np.stack([describe(text, bounds[i], bounds[j]) for i, j in spans]) @ self.weights
            ending: dict[int, list[tuple[int, float, int]]] = {}
            for (i, j), row in zip(spans, scores):
                k = int(row.argmax())
                if row[k] > 0:
                    ending.setdefault(j, []).append((i, float(row[k]), k))
            best, back = [0.0] * len(bounds), [(-1, -1)] * len(bounds)
            for j in range(1, len(bounds)):
                best[j], back[j] = best[j - 1], (j - 1, -1)
                for i, score, k in ending.get(j, ()):
                    if best[i] + score > best[j]:
                        best[j], back[j] = best[i] + score, (i, k)
            j = len(bounds) - 1
            while j > 0:
                i, k = back[j]
                if k >= 0:
                    out.append((bounds[i], bounds[j], KINDS[k]))
                j = i
        return sorted(out)


# --- Training ---------------------------------------------------------------------------------------


def made_up(rng: random.Random) -> Iterator[tuple[str, str | None]]:
    """Endless strings with their kind, in plain and disguised forms; None marks what only looks similar."""

    def number(n: int) -> str:
        return "".join(rng.choices("0123456789", k=n))

    def word() -> str:
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))

    while True:
        domain = [word() + rng.choice(["", number(1)]) for _ in range(rng.randint(1, 2))] + [rng.choice(sorted(_ENDINGS))]
        at = rng.choice([" at ", "(at)", "[at]", " (at) ", " [at] "])
        dot = rng.choice([" dot ", "[dot]", "(dot)"]) if at == " at " else rng.choice([" dot ", "[dot]", "."])
        yield rng.choice([word(), word() + "." + number(2), word() + "_" + word(), word() + " dot " + word()]) + at + dot.join(domain), "email"
        yield rng.choice(["[.]", ",", " . ", "(.)"]).join(str(rng.randint(0, 255)) for _ in range(4)), "ip"
        digits = number(15)
        digits += next(d for d in "0123456789" if luhn(digits + d))
        yield rng.choice([".", "/", "  ", "_", ". "]).join(digits[i : i + 4] for i in range(0, 16, 4)), "card"
        area, rest = "0" + number(rng.randint(2, 4)), number(3) + rng.choice(" -") + number(4)
        yield rng.choice([f"({area}) {rest}", f"{area}-{rest}", f"00{number(2)} {area[1:]} {rest}", f"{area} {rest}", f"{area}/{rest}"]), "phone"
        for plain in (
            f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
            f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1900, 2030)}",
            f"{number(3)},{number(3)},{number(3)}",
            f"{number(rng.randint(1, 5))}.{number(rng.randint(2, 8))}",
            number(rng.randint(7, 22)),
            " ".join(str(rng.randint(0, 99)) for _ in range(rng.randint(5, 9))),
            " ".join(number(4) for _ in range(rng.randint(2, 6))),
            ".".join(number(rng.randint(1, 4)) for _ in range(rng.choice([3, 5, 6]))),
            f"{word()} at {word()}. {word()} dot {word()}",
            "-".join(number(rng.randint(1, 3)) for _ in range(rng.randint(5, 8))),
        ):
            yield plain, None


def examples(windows: list[str], seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Windows, each with one string put in, and the spans that are right."""
    rng = random.Random(seed)
    source, out = made_up(rng), []
    hints = ("", "", "", "mail ", "phone: ", "card no. ", "ip ", "see ")
    for window in windows * max(1, -(-WINDOWS // max(1, len(windows)))):
        if len(out) >= 2 * WINDOWS:
            break
        string, kind = next(source)
        cut = window.find(" ", len(window) // 2)
        cut = cut if cut >= 0 else len(window)
        hint = rng.choice(hints)
        head = window[:cut] + " " + hint
        text = head + string + rng.choice([" ", ". ", ", ", "\n"]) + window[cut:].lstrip()
        out.append((text, [(len(head), len(head) + len(string), kind)] if kind else []))
    return out


def fit(windows: list[str], rounds: int = 80, rate: float = 0.5, shrink: float = 1e-3) -> Field:
    """Maximise the conditional likelihood of the right segmentations, by gradient ascent with adaptive steps."""
    cases = []
    for text, right in examples(windows or ["plain words without any data in them"]):
        taken = [s for s in base_spans(text) if not any(s[0] < e and s[1] > b for b, e, _ in right)]
        for region in regions(text, taken):
            bounds, spans = candidates(text, region)
            if not spans:
                continue
            gold = [KINDS.index(k) if k else -1 for i, j in spans for k in [next((k for b, e, k in right if (b, e) == (bounds[i], bounds[j])), None)]]
            features = np.stack([describe(text, bounds[i], bounds[j]) for i, j in spans])
            cases.append((len(bounds), spans, features, gold))
    weights, squares = np.zeros((FEATURES, len(KINDS))), np.full((FEATURES, len(KINDS)), 1e-6)
    weights[0] = -2
    for _ in range(rounds):
        gradient = -shrink * len(cases) * weights
        for n, spans, features, gold in cases:
            share = _marginals(n, spans, features @ weights)
            for row, k in enumerate(gold):
                if k >= 0:
                    share[row, k] -= 1
            gradient -= features.T @ share
        squares += gradient**2
        weights = weights + rate * gradient / np.sqrt(squares)
    return Field(weights)


def _marginals(n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """The chance of each span and kind, by the forward and backward sums over all segmentations."""
    top = scores.max(1)
    whole = (top + np.log(np.exp(scores - top[:, None]).sum(1))).tolist()
    ending: dict[int, list[int]] = {}
    starting: dict[int, list[int]] = {}
    for row, (i, j) in enumerate(spans):
        ending.setdefault(j, []).append(row)
        starting.setdefault(i, []).append(row)
    forward, backward = [0.0] * n, [0.0] * n
    for j in range(1, n):
        terms = [forward[j - 1]] + [forward[spans[r][0]] + whole[r] for r in ending.get(j, ())]
        high = max(terms)
        forward[j] = high + math.log(sum(math.exp(t - high) for t in terms))
    for i in range(n - 2, -1, -1):
        terms = [backward[i + 1]] + [backward[spans[r][1]] + whole[r] for r in starting.get(i, ())]
        high = max(terms)
        backward[i] = high + math.log(sum(math.exp(t - high) for t in terms))
    outside = np.array([forward[i] + backward[j] - forward[n - 1] for i, j in spans])
    return np.exp(np.minimum(outside[:, None] + scores, 0))


def train(df: DataFrame, text: str = "text") -> Field:
    """A field trained on windows of at most ``SAMPLE`` documents, at most ``WINDOWS`` windows of 160 characters."""
    ship(df.sparkSession)
    chosen = df.select(F.col(text).alias("text")).where("text is not null").select("text", F.xxhash64("text").alias("h")).orderBy("h").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for t in batch.column("text").to_pylist():
                places = [m.start() for m in islice(re.finditer(r"[0-9@]", t), 2)] + [0]
                cut += [t[max(0, p - 80) : p + 80] for p in dict.fromkeys(places)]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string())], names=["window"])

    found = sorted({r["window"] for r in chosen.mapInArrow(run, "window string").collect()})
    return fit(random.Random(1).sample(found, min(len(found), WINDOWS)))


# --- Operators --------------------------------------------------------------------------------------


_STRUCT = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def _find(text: str, field: Field) -> list[dict]:
    taken = base_spans(text)
    found = [(*s, True) for s in taken] + [(*s, False) for s in field.spans(text, taken)]
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return [{"kind": k, "start": a, "end": b, "base": base} for a, b, k, base in found]


def _redact(text: str | None, found: list[dict] | None) -> str | None:
    if text is None or not found:
        return text
    parts, at = [], 0
    for s in found:
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join(parts) + text[at:]


def find_pii(df: DataFrame, field: Field, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with all spans of each whole text: kind, start, end and whether a base pattern found it."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {spans: pa.array([_find(t, field) for t in strings(batch.column(text))], pa.list_(_STRUCT))}

    return add_columns(df, make, f"{spans} {SPANS}")


def redact(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with every found span replaced by its kind in angle brackets; overlapping spans become one. Null texts stay null."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {text: pa.array(map(_redact, batch.column(text).to_pylist(), batch.column(spans).to_pylist()), pa.string())}

    return add_columns(df, make, f"{text} string")


def find_and_redact(df: DataFrame, field: Field, text: str = "text", spans: str = "spans") -> DataFrame:
    """``redact`` of ``find_pii`` in one pass; the spans are those of the text before."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column(text).to_pylist()
        found = [_find(t or "", field) for t in texts]
        return {spans: pa.array(found, pa.list_(_STRUCT)), text: pa.array(map(_redact, texts, found), pa.string())}

    return add_columns(df, make, f"{text} string, {spans} {SPANS}")
