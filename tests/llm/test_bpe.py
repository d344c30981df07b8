"""Operator 1 against the tokenizers library."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vecloom.llm import bpe
from vecloom.llm.encoder import LETTER, NUMBER, OTHER, Encoder, tokenizer_file
from vecloom.llm.queries import BYTE_BPE

import pyarrow as pa


@pytest.fixture(scope="module")
def encoder():
    return Encoder(*tokenizer_file(BYTE_BPE))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def same(encoder, library, texts):
    got = [x.tolist() for x in encoder.encode_column(pa.array(texts, pa.string()))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for ids in got:
        decoded = encoder.decode_bytes(np.array(ids, np.int64)).tobytes().decode("utf-8", "replace")
        assert decoded == library.decode(ids, skip_special_tokens=False)


PARTS = ["a", "s", "t", "re", "ll", "'", "'s", "'ve", " ", "  ", "\n", "\t", "\xa0", "　", "\x85", "1", "²", "é"]
PARTS += ["!", "?!", "<|endoftext|>", "<|", "中文", "ß", "́", "🙂", "\x00", "don't", "\r\n", "ſ", "٣", " '"]


def test_mixed_pieces(encoder, library):
    random.seed(3)
    texts = ["".join(random.choices(PARTS, k=random.randrange(40))) for _ in range(5000)]
    same(encoder, library, [*texts, "", None, "  ", "a" * 5000, "<|endoftext|>"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(encoder, library, texts):
    same(encoder, library, texts)


def test_long_texts(encoder, library):
    words = "the reason of it, isn't  clear\n" * 200_000
    same(encoder, library, [words, "x", "ab" * 1_500_000 + " end"])


def test_letter_classes(encoder, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for probe, name in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
        for at in range(0, len(points), 1 << 16):
            block = points[at : at + (1 << 16)]
            text = "".join(f"{probe}{chr(c)}\n" for c in block)
            starts = np.zeros(len(text) + 1, bool)
            starts[[s for _, (s, _) in library.pre_tokenizer.pre_tokenize_str(text)]] = True
            assert (~starts[1 : 3 * len(block) : 3] == (encoder.classes[block] == name)).all()


def test_shared_keys_are_noticed(encoder, library, monkeypatch):
    other = Encoder(*tokenizer_file(BYTE_BPE))
    other.byte_values = np.ones(256, np.uint64)  # every fragment of one length has one key
    same(other, library, ["the cat sat", "a dog ran", ""])


def test_operator(docs, library):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (1, "Hello  world"), (None, "x\ny")]
    frame = docs(rows).drop("ids")
    done = bpe.decode(bpe.encode(frame, BYTE_BPE), BYTE_BPE, text="decoded").collect()
    assert sorted((r.doc_id or 0, r.text or "", r.decoded) for r in done) == sorted(
        (i or 0, t or "", t or "") for i, t in rows
    )
    for r in done:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    assert {"row", "packed"} <= set(frame.columns)
    assert bpe.encode(frame.limit(0), BYTE_BPE).count() == 0


def test_column_function(docs, library):
    found = docs([(1, "un été à Paris"), (2, None)]).select("doc_id", bpe.round_trip(BYTE_BPE)(F.col("text")).alias("t"))
    rows = {r.doc_id: r.t for r in found.collect()}
    assert rows[1].decoded == "un été à Paris" and rows[2].ids == [] and rows[2].decoded == ""
