"""Operator 5: secrets by fixed patterns and by token efficiency.

A BPE vocabulary spells words in few tokens and random strings in many: a string of
``shortest`` characters or more with fewer than ``efficiency`` to a token is taken for a random
one, whatever letters or digits it is made of. Known digests (hex of the usual digest lengths),
UUIDs and identifiers are set aside first. An identifier is words of two letters or more, and
short numbers, joined by case, ``_``, ``-`` or ``/``; its words are weighed without what joins
them, at the lower ratio ``word_efficiency``, so a random string that only has the form of one
is still found: of 20 random lower-case letters 92 in 100, of mixed case all. The fixed patterns (the
base) stay whatever their efficiency; random strings are added where they touch no base span.
One narrow Arrow pass; places are code points.

A null text is empty and has no spans. Texts are taken whole. Strings of any length are
weighed in blocks of PIECE characters. Ties go by the order of the kinds. Repeated rows
give the same spans; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
# Fewer characters to a token than this look random; English words have over four.
EFFICIENCY = 2.2
# Words of a language that the vocabulary does not know well come down to 1.9.
WORD_EFFICIENCY = 1.9
SHORTEST = 20
PIECE = 512

# The patterns of the base.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_LONG = "[A-Za-z0-9+/_=-]{%d,}"
_DIGESTS = {32, 40, 48, 56, 64, 96, 128}
_ALL_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# Words of two letters or more, letters that stand alone, or short numbers, one after another.
# Nothing is given back, so any string takes linear time.
_IDENTIFIER = re.compile(
    r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|(?<![A-Za-z0-9])[A-Za-z](?![A-Za-z0-9])|[0-9]{1,4}+|[_/=+-]++)++"
)
_WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}")


def encoding_file(path: str) -> str:
    """The text of a tiktoken rank file, for the tasks."""
    with open(path, encoding="ascii") as file:
        return file.read()


_made: dict[int, tiktoken.Encoding] = {}


def _encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    key = hash((ranks, pattern))
    if key not in _made:
        table = {base64.b64decode(t): int(n) for t, n in (line.split() for line in ranks.splitlines() if line)}
        _made[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _made[key]


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    found = []
    lowered = text.encode("utf-8", "replace").lower()
    if any(word in lowered for word in _WORDS):
        found += [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def per_token(span: str, encoding: tiktoken.Encoding) -> float:
    """Characters to a token."""
    tokens = sum(len(encoding.encode_ordinary(span[i : i + PIECE])) for i in range(0, len(span), PIECE))
    return len(span) / tokens


def looks_random(
    span: str, encoding: tiktoken.Encoding, efficiency: float = EFFICIENCY, word_efficiency: float = WORD_EFFICIENCY
) -> bool:
    if _UUID.fullmatch(span) or len(span) in _DIGESTS and _ALL_HEX.fullmatch(span):
        return False
    if _IDENTIFIER.fullmatch(span):
        words = _WORD.findall(span)
        letters = sum(map(len, words))
        return bool(words) and letters / sum(len(w) / per_token(w, encoding) for w in words) < word_efficiency
    return per_token(span, encoding) < efficiency


def random_spans(
    text: str, base: list[tuple], encoding: tiktoken.Encoding, long: re.Pattern, *ratios: float
) -> list[tuple[int, int, str, int]]:
    found = []
    for m in long.finditer(text):
        touched = any(s < m.end() and m.start() < e for s, _, _, e in base)
        if not touched and looks_random(m[0], encoding, *ratios):
            found.append((m.start(), 3, "random", m.end()))
    return found


def find(
    ranks: str,
    pattern: str,
    text: Column,
    shortest: int = SHORTEST,
    efficiency: float = EFFICIENCY,
    word_efficiency: float = WORD_EFFICIENCY,
) -> Column:
    """(base, spans): sorted spans (start, place of the kind, kind, end) of a text."""
    kind = "array<struct<start:int,place:int,kind:string,end:int>>"
    span = pa.struct([("start", pa.int32()), ("place", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])

    @F.arrow_udf(f"struct<base:{kind},spans:{kind}>")
    def found(texts: pa.Array) -> pa.Array:
        encoding, long = _encoding(ranks, pattern), re.compile(_LONG % shortest)
        base, spans = [], []
        for value in texts.to_pylist():
            some = base_spans(value or "")
            more = sorted(some + random_spans(value or "", some, encoding, long, efficiency, word_efficiency))
            for out, rows in ((base, some), (spans, more)):
                out.append([dict(zip(("start", "place", "kind", "end"), r, strict=True)) for r in rows])
        return pa.StructArray.from_arrays([pa.array(x, pa.list_(span)) for x in (base, spans)], ["base", "spans"])

    return found(text)
