"""Importance resampling against plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.llm import resampling, word_runs
from vecloom.llm.queries import QUERIES


def features(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, target, percent=5, least=20):
    found = [features(text) for _, text in docs]
    s, t = Counter(), Counter()
    for _, own in found:
        s.update(own)
    for text in target:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)
    ]
    rows = []
    for (doc_id, _), (n, own) in zip(docs, found, strict=True):
        name = f"42:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        rows.append([doc_id, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    eligible = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(eligible[: percent * len(eligible) // 100]):
        row[5] = place + 1
    return sorted(map(tuple, rows), key=str)


def answer(df):
    columns = "doc_id", "n_words", "n_features", "weight", "score", "rank"
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


TEXTS = [
    "One two\nTHREE-four 5six Ärger ärger naïve 中文　x",
    "",
    None,
    "?! -- \x00\x7f",
    "w" * 200 + " " + "v" * 70 + " a " + "u" * 300,
    " ".join(f"word{i % 7}" for i in range(5000)),
    "solo",
    "two words",
]


@pytest.mark.parametrize("words, size", [(1, 8), (3, 50), (200_000, 1 << 20)])
def test_runs_in_any_pieces(monkeypatch, words, size):
    monkeypatch.setattr(word_runs, "WORDS", words)
    monkeypatch.setattr(word_runs, "BYTES", size)
    found = [[] for _ in TEXTS]
    count = np.zeros(len(TEXTS), int)
    for of, crc, owner in word_runs.runs((t or "").encode() for t in TEXTS):
        count += np.bincount(owner, minlength=len(TEXTS))
        for number, value in zip(of.tolist(), (crc % 10000).tolist(), strict=True):
            found[number].append(value)
    for text, own, n in zip(TEXTS, found, count, strict=True):
        want, buckets = features(text)
        assert (n, sorted(own)) == (want, sorted(buckets))


def rows_of(n):
    return [(i, " ".join(f"w{(i * j) % 97}" for j in range(15 + i % 12))) for i in range(n)]


@pytest.mark.parametrize("percent", [0, 5, 100])
def test_draw_against_loops(docs, spark, percent):
    rows = [*rows_of(120), *((900 + i, t) for i, t in enumerate(TEXTS)), (None, "null id " * 20), (None, "null id " * 20)]
    target = ["w1 w2 w3 w4", None, "w5 w10 w15", "null id null"]
    made = docs(rows).withColumns({c: F.lit("x") for c in ("others", "score", "rank", "place", "range", "weight")})
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(made.repartition(4), goal, percent, keep=("score",)) if percent == 5 else None
    if found is not None:
        assert "score" in found.columns
    found = resampling.resample(made.repartition(4), goal, percent)
    assert answer(found) == brute(rows, target, percent)


def test_ties_and_repeated_rows(docs, spark):
    rows = [(i % 3, "same text of words " * 6) for i in range(60)]
    goal = spark.createDataFrame([("same text",)], "text string")
    found = answer(resampling.resample(docs(rows).repartition(5), goal, 10))
    assert found == brute(rows, ["same text"], 10)


@pytest.mark.parametrize("first", [(None, -(10**9)), (10**9, None), (10**8, 10**9), (0, 0)])
def test_bracket_is_widened(spark, monkeypatch, first):
    rows = spark.range(1000).selectExpr("id AS doc_id", "(id * 7919) % 1000 AS score", "id AS row")
    honest, asked = resampling.bracket, []

    def wrong(df, percent, margin):
        asked.append(margin)
        return first if len(asked) == 1 else honest(df, percent, margin)

    monkeypatch.setattr(resampling, "bracket", wrong)
    score, doc_id, _ = resampling.cutoff(rows, 5)
    assert score == 950 and (doc_id * 7919) % 1000 == 950 and len(asked) > 1


def test_empty_tables(docs, spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(docs([]), none).count() == 0
    rows = rows_of(40)
    assert answer(resampling.resample(docs(rows), none)) == brute(rows, [])


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = QUERIES["op13_importance_resampling"](spark, sf).collect()
    want = {r[0]: r[2:] for r in brute(rows, target)}
    assert {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in found} == want
