"""Operator 8: the plan, the pieces and their places."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from vecloom.llm.packing import pack, packing_rules
from vecloom.llm.queries import BYTE_BPE


def filled(counts, capacity):
    rules = packing_rules(counts, capacity)
    bins = {}
    by_length = {}
    for rule in rules:
        by_length.setdefault(rule[0], []).append(rule)
    for length, many in counts.items():
        for rank in range(many):
            _, first, start, each, offset = [r for r in by_length[length] if r[1] <= rank][-1]
            nth = rank - first
            bins.setdefault(start + nth // each, []).append((offset + nth % each * length, length))
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_gapless_and_tight(seed):
    random.seed(seed)
    capacity = random.choice([10, 30, 64, 2048])
    lengths = [random.randint(1, capacity) for _ in range(random.randint(1, 400))]
    if seed % 3 == 0:
        lengths += [random.choice(lengths)] * 300
    bins = filled(Counter(lengths), capacity)
    assert sorted(bins) == list(range(len(bins)))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in content) <= 2
    assert sum(map(len, bins.values())) == len(lengths)
    # No worse than first fit on the lengths from the longest on, but for one bin.
    free = []
    for length in sorted(lengths, reverse=True):
        at = next((i for i, gap in enumerate(free) if gap >= length), None)
        if at is None:
            free.append(capacity - length)
        else:
            free[at] -= length
    assert len(bins) <= len(free) + 1


def test_plan_of_nothing():
    assert packing_rules({}, 2048) == []


def test_pieces(docs):
    long = " ".join(f"word{i} of the text" for i in range(3000))
    rows = [(1, long), (2, None), (3, ""), (4, "short text"), (4, "short text"), (None, "no id"), (5, "x" * 9000)]
    library = Tokenizer.from_file(BYTE_BPE)
    capacity = 256
    done = [r.asDict() for r in pack(docs(rows), BYTE_BPE, capacity=capacity, keep_ids=True).collect()]
    whole = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % capacity or capacity
        edges = [0, *range(head, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            whole[i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert whole == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in done)
    for r in done:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    places = {}
    for r in done:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in places.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity


def test_one_common_length(spark):
    frame = spark.range(50_000).selectExpr("id AS doc_id", "'the same text' AS text")
    done = pack(frame, BYTE_BPE, capacity=64).toPandas()
    assert len(done) == 50_000
    assert done.groupby("sequence_id").length.sum().max() <= 64
    assert not done.duplicated(["sequence_id", "offset"]).any()
    assert done.sequence_id.nunique() == -(-50_000 // (64 // done.length[0]))


def test_empty_table(docs):
    assert pack(docs([]), BYTE_BPE).count() == 0
