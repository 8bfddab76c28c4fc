"""Token counts with a whole-token shortcut.

On the driver every vocabulary string is encoded alone; those that give one token form the shortcut.
A pre-token in it counts one, any other is merged. Null texts count as empty: no bytes, no tokens.
Special tokens inside texts count one each, as the library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from clickloom.llm.bpe import SHIFT, Merges, cutter, merge, odd_characters, remembered, send
from clickloom.llm.texts import add_columns, strings


def byte_letters() -> dict[str, int]:
    """Characters by which vocabulary files write bytes: printable Latin-1 stands for itself, the rest follow U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def library_odd() -> tuple[str, str]:
    """Characters that the library, by its pre-tokeniser, does not join to a letter or number."""
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    joined = lambda head: lambda c: len(split(head + c)) == 1
    return odd_characters(joined("a"), joined("1"))


@functools.cache
def load(path: str) -> tuple[Merges, frozenset[str], tuple[str, ...]]:
    """Merges, strings that encode alone as one token, and special strings of a byte-level BPE file."""
    with open(path, "rb") as f:
        data = f.read()
    spec = json.loads(data)
    model, cut = spec["model"], spec["pre_tokenizer"]
    special = [t["content"] for t in spec["added_tokens"]]
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
    if spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or model["type"] != "BPE" or model.get("ignore_merges") or not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    vocab, letters = model["vocab"], byte_letters()
    pairs, made = {}, []
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        pairs[vocab[left] << SHIFT | vocab[right]] = rank
        made.append(vocab[left + right])
    byte_ids = [0] * 256
    for letter, b in letters.items():
        byte_ids[b] = vocab[letter]
    table = Merges(hashlib.sha256(data).hexdigest(), pairs, made, byte_ids)
    whole = set()
    for token, number in vocab.items():
        if token in special:
            continue
        raw = bytes(letters[c] for c in token)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if merge(raw, table) == [number]:
            whole.add(text)
    return table, frozenset(whole), tuple(special)


def count_tokens(df: DataFrame, path: str, pattern: str, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the UTF-8 length and the number of tokens of each whole text."""
    sent = send(df, ("json", load(path)[0].key), lambda: (*load(path), library_odd()))

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        table, whole, special, odd = sent.value
        cut = cutter(pattern, odd)
        known = remembered("counts" + table.key, lambda piece: 1 if piece in whole else len(merge(piece.encode(), table)))
        between = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))).split if special else lambda t: [t]
        sizes, counts = [], []
        for text_ in strings(batch.column(text)):
            parts = between(text_) if any(s in text_ for s in special) else [text_]
            sizes.append(len(text_.encode()))
            counts.append(len(parts) - 1 + sum(sum(map(known.__getitem__, cut(part))) for part in parts))
        return {n_bytes: pa.array(sizes, pa.int64()), n_tokens: pa.array(counts, pa.int64())}

    return add_columns(df, make, f"{n_bytes} bigint, {n_tokens} bigint", "pieces")
