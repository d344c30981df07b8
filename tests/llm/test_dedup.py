"""Operators 7, 9 and 10 against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vecloom.llm import blocks, embedding_dups, simhash, substring
from vecloom.llm.components import connected_components
from vecloom.llm.fm_index import FMIndex
from vecloom.llm.words import word_hashes

WORDS = [f"w{i}" for i in range(300)]


def some_texts(seed, n=120):
    """Texts with copies, edited copies, shared passages and text that repeats itself."""
    random.seed(seed)
    passages = [random.choices(WORDS, k=random.randint(15, 60)) for _ in range(4)]
    texts = []
    for i in range(n):
        kind = random.random()
        words = random.choices(WORDS, k=random.randint(0, 80))
        if kind < 0.3:
            at = random.randint(0, len(words))
            words[at:at] = random.choice(passages)
        elif kind < 0.45 and texts:
            words = random.choice(texts).split()
            if words and random.random() < 0.6:
                words[random.randrange(len(words))] = "edited"
        elif kind < 0.55:
            words = (random.choices(WORDS[:5], k=random.randint(1, 4)) * 30)[: random.randint(1, 90)]
        texts.append(random.choice([" ", "\n", "  \t"]).join(words))
    return [(i * 7 % (n + 1), t) for i, t in enumerate(texts)]


EDGES = [(500, None), (501, ""), (502, " \n "), (None, "a b c"), (503, "é \x00 ü"), (504, "A b C"), (505, "a B c")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_passages(docs, seed):
    rows = some_texts(seed) + EDGES
    found = substring.remove_repeats(docs(rows), keep=("row", "packed", "spans"))
    got = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256), "row", "packed", "spans").collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(brute.repeats(rows), key=repr)
    assert {tuple(r)[4:] for r in got} == {(1, "x", "y")}


def test_repeated_rows_and_ids(docs):
    text = " ".join(WORDS[:50])
    rows = [(1, text), (1, text), (2, text), (1, text + " more"), (None, text), (None, text)]
    got = substring.remove_repeats(docs(rows)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.repeats(rows), key=repr)


def test_passages_of_a_hot_anchor(docs, monkeypatch):
    """Many distinct segments of one anchor are cut into blocks."""
    monkeypatch.setattr(substring, "BLOCK_ROWS", 20)
    random.seed(5)
    shared = random.choices(WORDS, k=30)
    rows = []
    for i in range(300):
        rows.append((i, " ".join([f"a{i}", f"b{i}", *shared, f"c{i}", f"d{i}"])))
    got = substring.remove_repeats(docs(rows)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.repeats(rows))


def test_restored_text(docs):
    rows = [(1, "left \n as it was"), (2, " ".join(WORDS[:30])), (3, " ".join(WORDS[:30]) + "\n tail")]
    got = {r.doc_id: r.kept for r in substring.remove_repeats(docs(rows), restore=True).collect()}
    assert got[1] == "left \n as it was" and got[3] == "tail"


def test_long_text(docs):
    random.seed(9)
    text = " ".join(random.choices(WORDS, k=60_000))
    rows = [(1, text), (2, "x " + text), (3, "the " * 50_000), (4, "y" * 3_000_000)]
    got = substring.remove_repeats(docs(rows)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.repeats(rows))


def test_empty_tables(docs, spark):
    assert substring.remove_repeats(docs([])).count() == 0
    assert simhash.near_duplicates(docs([])).count() == 0
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dups.near_duplicates(empty).count() == 0


def test_words():
    raw = "one\ttwo  é\x0b\x85x\x1f ".encode()
    starts, ends, hashes = word_hashes(raw)
    assert [raw[s:e] for s, e in zip(starts, ends, strict=True)] == raw.split()
    assert len(set(hashes.tolist())) == 4
    assert word_hashes(b"")[0].size == 0
    again = word_hashes(b"zzz one two")[2]
    assert again[1] == hashes[0] and again[2] == hashes[1]


@pytest.mark.parametrize("seed", range(5))
def test_backward_search(seed):
    random.seed(seed)
    symbols = []
    for _ in range(40):
        symbols += [random.randint(1, 6) for _ in range(random.randint(1, 30))] + [0]
    symbols = np.array(symbols)
    index = FMIndex(symbols, 5)
    ends = np.array([i for i in range(5, len(symbols) + 1) if 0 not in symbols[i - 5 : i]])
    which, low, high = index.search(symbols, ends, 5)
    found = {int(w): (int(a), int(b)) for w, a, b in zip(which, low, high, strict=True)}
    for n, end in enumerate(ends.tolist()):
        pattern = symbols[end - 5 : end]
        places = {i for i in range(len(symbols) - 4) if (symbols[i : i + 5] == pattern).all()}
        if len(places) == 1:
            assert n not in found
        else:
            a, b = found[n]
            assert set(index.suffixes[a:b].tolist()) == places


@pytest.mark.parametrize("seed", [1, 2])
def test_simhash(docs, seed):
    rows = some_texts(seed) + EDGES + [(7, "same row"), (7, "same row")]
    got = simhash.near_duplicates(docs(rows), keep=("row", "ids"))
    got = got.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"), "component_id", "row", "ids").collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(brute.simhash(rows), key=repr)
    assert {tuple(r)[3:] for r in got} == {(1, "z")}


@pytest.mark.parametrize("block", [4, 1000])
def test_simhash_links_of_dense_prints(spark, block):
    random.seed(4)
    prints = set()
    for _ in range(6):
        centre = random.getrandbits(64)
        for _ in range(60):
            value = centre
            for _ in range(random.randint(0, 4)):
                value ^= 1 << random.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    groups = brute.Groups()
    for i, a in enumerate(prints):
        for b in prints[: i + 1]:
            if (a ^ b).bit_count() <= 2:
                groups.join(a, b)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    edges = simhash.links(frame, block=block).collect()
    found = brute.Groups()
    for a, b in edges:
        a, b = a % 2**64, b % 2**64
        assert (a ^ b).bit_count() <= 2
        found.join(a, b)
    for p in prints:
        assert found.find(p) == groups.find(p)


def test_larger_radius_is_refused(docs):
    with pytest.raises(ValueError, match="radius"):
        simhash.near_duplicates(docs([(1, "a")]), radius=3)


def test_wide_near_pairs_are_all_pairs():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, (12, 4), dtype=np.uint64)[rng.integers(0, 12, 300)]
    for row in values:
        for bit in rng.integers(0, 256, rng.integers(0, 60)):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    ends = np.repeat([130, 131, 300], [130, 1, 169])
    for radius in (5, 47, 64):
        found = set()
        for i, j in simhash.near_pairs(values, ends, radius):
            found |= set(zip(i.tolist(), j.tolist(), strict=True))
        distance = lambda i, j: int(np.bitwise_count(values[i] ^ values[j]).sum())
        want = {(i, j) for i in range(300) for j in range(i + 1, int(ends[i])) if distance(i, j) <= radius}
        assert found == want


def test_near_pairs_are_all_pairs():
    random.seed(8)
    values = np.array([random.getrandbits(6) for _ in range(500)], np.uint64)
    ends = np.repeat([130, 131, 400, 500], [130, 1, 269, 100])
    for radius in (0, 1, 2):
        found = set()
        for i, j in simhash.near_pairs(values, ends, radius):
            found |= set(zip(i.tolist(), j.tolist(), strict=True))
        want = {
            (i, j)
            for i in range(500)
            for j in range(i + 1, int(ends[i]))
            if int(values[i] ^ values[j]).bit_count() <= radius
        }
        assert found == want


def clustered(seed, n=260, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(20)] + rng.standard_normal(dim) * rng.choice([0.05, 0.2, 0.35, 2.0])
        rows.append((i * 3, [float(x) for x in v.astype("float32")]))
    rows += [(1, rows[0][1]), (2, rows[0][1]), (4, [0.0] * dim), (5, None), (7, [1.0] * 3), (8, [2.0] * 3)]
    rows += [(10, [float("nan")] * dim), (11, [None, *[1.0] * (dim - 1)]), (13, []), (14, [float("inf")] * dim)]
    return rows


@pytest.mark.parametrize("block", [16, 1024])
def test_embedding_links(spark, block):
    rows = clustered(2)
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id bigint, embedding array<float>, node int")
    got = {r.vec_id: r for r in embedding_dups.near_duplicates(frame, block=block, recall=0.9999).collect()}
    want = brute.cosine_links(rows)
    assert len(got) == len(rows)
    assert sum(n for _, n, _ in want) > 500
    for i, n, component in want:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, component, i == component)


def test_embedding_repeated_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [-0.0, 1.0]), (4, [0.0, 1.0]), (None, [1.0, 0.01])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((tuple(r) for r in embedding_dups.near_duplicates(frame, recall=0.9999).collect()), key=repr)
    assert got == sorted(
        [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 1, 3, True), (4, 1, 3, False), (None, 3, 1, False)],
        key=repr,
    )


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)]
    edges += [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2060)] + [(5, 5), (None, 3)]
    groups = brute.Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.join(a, b)
    frame = spark.createDataFrame(edges, "x bigint, y bigint")
    got = sorted(map(tuple, connected_components(frame, "x", "y").collect()))
    assert got == sorted((i, groups.find(i)) for i in list(groups))
    assert connected_components(frame.limit(0), "x", "y").count() == 0


def test_blocks_let_all_rows_of_a_bucket_meet(spark):
    frame = spark.range(200).selectExpr("id", "id % 3 % 2 AS bucket")
    met = blocks.block_pairs(frame, 30, ["id"], "id").collect()
    groups = {}
    for r in met:
        groups.setdefault((r.bucket, r.left, r.right), []).append(r.id)
    assert max(map(len, groups.values())) < 120
    pairs = {(a, b) for rows in groups.values() for a in rows for b in rows}
    for a in range(200):
        for b in range(200):
            if a % 3 % 2 == b % 3 % 2:
                assert (a, b) in pairs
