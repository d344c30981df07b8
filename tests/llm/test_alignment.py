"""Token alignment against a plain version by the libraries themselves."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vecloom.llm import alignment
from vecloom.llm.encoder import byte_letters
from vecloom.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

COLUMNS = "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
TEXTS = [
    "Hello world, it's fine.\n\nNew  line   here ",
    "",
    None,
    "<|endoftext|> stays text",
    "emoji \U0001f600 é ü中文 \x00 \x7f",
    "a ▁ b",
    "   ",
    "\n",
    "x",
    "one two three four " * 4000,
    "word" * 3000,
    "one two three four " * 3,
    "one two three four " * 3,
    "tab\tand\r\nbreak  it's we'll 12345 1,000",
]


def brute(texts):
    whole = Tokenizer.from_file(BYTE_BPE)
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}

    def spelled_a(i):
        return bytes(byte_of[c] for c in whole.id_to_token(i))

    def spelled_b(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for text in texts:
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(map(spelled_a, a)) != raw or b"".join(map(spelled_b, b)) != raw:
            found.append(([], []))
            continue
        ends = {}
        for side, ids, spelled in ((0, a, spelled_a), (1, b, spelled_b)):
            at = 0
            for i in ids:
                at += len(spelled(i))
                ends.setdefault(at, {})[side] = i
        links, groups, own = [], [], ([], [])
        for at in sorted(ends):
            for side in (0, 1):
                if side in ends[at]:
                    own[side].append(ends[at][side])
            if len(ends[at]) == 2:
                links.append((ends[at][0], ends[at][1]))
                groups.append("|".join(",".join(map(str, side)) for side in own))
                own = ([], [])
        found.append((links, [len(a), len(b), len(groups), ";".join(groups)]))
    counts = Counter(link for links, _ in found for link in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    rows = []
    for links, rest in found:
        if not links:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[x] == most[x[1]] for x in links)
        total = sum(counts[x] for x in links)
        rows.append((*rest[:3], len(links), best, total, hashlib.sha256(rest[3].encode()).hexdigest()))
    return rows


def answer(df):
    return [tuple(r[c] for c in COLUMNS) for r in sorted(df.collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("piece", [50, alignment.PIECE])
def test_against_the_libraries(piece):
    """Pieces and parts of any size give the same: whole texts, in one process."""
    expected = brute(TEXTS)
    patch = pytest.MonkeyPatch()
    patch.setattr(alignment, "PIECE", piece)
    patch.setattr(alignment, "ROW_LINKS", 7 * piece)
    patch.setattr(alignment, "REMEMBERED", piece)
    with open(PIECE_BPE, "rb") as other:
        aligner = alignment.Aligner(alignment.plain_tokenizer(BYTE_BPE), other.read())
    rows = list(alignment.aligned(aligner, TEXTS))
    patch.undo()
    assert len(rows) == len(TEXTS)
    for own, want in zip(rows, expected, strict=True):
        assert all(r[2:6] == (*want[:3], want[6]) for r in own)
        assert sum(len(r[6]) for r in own) == want[3]
        assert [r[0] for r in own] == list(range(own[0][1]))


def test_whole_table_with_counts(docs, monkeypatch):
    made = docs(list(enumerate(TEXTS))).withColumns({"n_a": F.lit(1), "links": F.lit("x"), "found": F.lit(2)})
    found = alignment.align(made.repartition(3), BYTE_BPE, PIECE_BPE, keep=("row", "found"))
    assert answer(found) == brute(TEXTS)
    assert {(r.row, r.found) for r in found.collect()} == {(1, 2)}


def test_registered_query(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    assert answer(QUERIES["op12_token_alignment"](spark, sf)) == brute(texts)


def test_long_text_in_several_rows(spark, monkeypatch):
    text = "some words of a long text " * 60_000
    rows = spark.createDataFrame([(1, text), (2, "some words")], "doc_id bigint, text string")
    assert answer(alignment.align(rows, BYTE_BPE, PIECE_BPE)) == brute([text, "some words"])


def test_empty_table(docs):
    assert alignment.align(docs([]), BYTE_BPE, PIECE_BPE).count() == 0


def test_links_are_pairs_of_suffixes():
    assert alignment.possible_pairs([b"ab", b"b", b"c"], [b"b", b"xab", b"b"]) == 6
