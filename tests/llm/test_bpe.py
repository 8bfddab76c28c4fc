"""Token counts and BPE against the libraries whose vocabularies they use."""

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from clickloom.llm import bpe, tokens

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    " ",
    "plain words, and don't we'll\n\n  spaces \t\r\n ",
    "a<|endoftext|> b<|endoftext|><|endoftext|>  c",
    "Ünïcode ñ 你好 привет मराठी 🙂🙃   　x \u0085 \x1c\x1d",
    "՘a࢏1꟎ ⑤½² \U000323b0\U00010940",
    "x" * 5000,
    "ab" * 3000 + " " * 4000 + "9" * 2000,
    "same",
    "same",
]


@pytest.fixture(scope="module")
def library():
    ranks, _ = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_character_is_cut_as_the_library_does():
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    cut = bpe.Pieces(P.PATTERN, tokens.library_odd())
    for c in [*range(1, 0x3000), *range(0xA000, 0xD800), *range(0xF900, 0x1F000), *range(0x31000, 0x34000, 7)]:
        text = f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}. {chr(c)}"
        got = cut(text)
        assert "".join(got) == text
        assert [len(x) for x in got] == [b - a for _, (a, b) in split(text)], hex(c)


def test_encode_and_decode(spark, rows, library):
    df = rows([(i, t, "x", 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, decoded int")
    got = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    for r in got.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_unknown_ids_decode_to_null(rows):
    df = rows([(1, [0, 50256]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, RANKS).collect()}
    assert got == {1: None, 2: None, 3: b""}


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ranks, key = bpe.load_ranks(RANKS)
    table = bpe.merges_of_ranks(ranks, key)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cut = bpe.Pieces(P.PATTERN, bpe.tiktoken_odd(P.PATTERN))
    assert [i for piece in cut(text) for i in bpe.merge(piece.encode(), table)] == enc.encode_ordinary(text)


def test_counts(rows):
    lib = Tokenizer.from_file(JSON)
    df = rows([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, N_TOKENS int")
    got = tokens.count_tokens(df, JSON, P.PATTERN).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(lib.encode(text, add_special_tokens=False).ids))


def test_shortcut_strings_are_single_tokens():
    lib = Tokenizer.from_file(JSON)
    table, whole, _ = tokens.load(JSON)
    assert len(whole) > 45_000
    sample = sorted(whole)[::50]
    assert all(len(e.ids) == 1 for e in lib.encode_batch(sample, add_special_tokens=False))
