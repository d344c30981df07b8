"""The block kernel against brute force in float64, without Spark."""

import numpy as np
import pyarrow as pa
import pytest

from vecloom.operators.kernel import BestRows, pack, parts_by_cell, queries_by_cell, to_matrix, to_unit


def expected(queries, vectors, ids, k, metric="ip", allowed=None):
    queries, vectors = queries.astype("float64"), vectors.astype("float64")
    if metric == "cosine":
        queries, vectors = to_unit(queries), to_unit(vectors)
    out = []
    for q in range(len(queries)):
        scores = np.round(np.einsum("j,ij->i", queries[q], vectors), 9) + 0.0
        rows = [j for j in range(len(ids)) if allowed is None or allowed[q][j]]
        out += [(q, ids[j], scores[j]) for j in sorted(rows, key=lambda j: (-scores[j], ids[j]))[:k]]
    return out


def run(queries, blocks, ids, k, metric="ip", parts=None):
    best = BestRows(queries, k, metric)
    start = 0
    for block in blocks:
        rows = pa.table({"id": ids[start : start + len(block)]})
        best.offer(rows, block, None if parts is None else parts(start, len(block)))
        start += len(block)
    table = best.table()
    rows = [] if table is None else zip(*(table.column(c).to_pylist() for c in ("query", "id", "score")))
    return sorted(rows, key=lambda r: (r[0], -r[2], r[1]))


@pytest.mark.parametrize("seed", range(12))
def test_random_blocks(seed):
    rng = np.random.default_rng(seed)
    dim, count, asked = rng.integers(1, 70), rng.integers(1, 4000), rng.integers(1, 700)
    k = int(rng.integers(1, 30))
    vectors = rng.normal(size=(count, dim)).astype("float32")
    queries = rng.normal(size=(asked, dim)).astype("float32")
    if seed % 3 == 0:  # many equal scores
        vectors, queries = np.round(vectors), np.round(queries)
    if seed % 4 == 1:
        vectors *= np.float32(1e12)
    if seed % 4 == 2:
        vectors[rng.random(count) < 0.5] = vectors[0]
    metric = "cosine" if seed % 2 else "ip"
    ids = [f"id{n}" for n in rng.permutation(count)]
    cuts = np.sort(rng.integers(0, count + 1, size=3))
    blocks = np.split(vectors, cuts)
    got = run(queries, blocks, ids, k, metric)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in expected(queries, vectors, ids, k, metric)]


def test_nearly_equal_scores_are_told_apart():
    """Differences far below float32 still decide the order."""
    base = np.random.default_rng(1).normal(size=32)
    vectors = np.stack([base * (1 + n * 1e-8) for n in range(300)])
    ids = [f"{n:03d}" for n in range(300)]
    got = run(base[None, :], [vectors[:100], vectors[100:]], ids, 5)
    assert [i for _, i, _ in got] == [f"{n:03d}" for n in range(299, 294, -1)]


def test_very_large_vectors_use_float64():
    vectors = np.array([[1e30, 0.0], [2e30, 0.0], [0.0, 3e30]], dtype="float32")
    got = run(np.array([[1e30, 1.0]], dtype="float32"), [vectors], ["a", "b", "c"], 2)
    assert [i for _, i, _ in got] == ["b", "a"]


def test_integer_ids_order_as_numbers():
    got = run(np.ones((1, 2)), [np.ones((20, 2), "float32")], list(range(20)), 3)
    assert [i for _, i, _ in got] == [0, 1, 2]


@pytest.mark.parametrize("seed", range(6))
def test_cells(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(900, 8)).astype("float32")
    queries = rng.normal(size=(40, 8)).astype("float32")
    cells = rng.integers(0, 6, size=(900, 3)) + np.arange(3) * 6
    cells[: 900 // 3] = [0, 6, 12]  # a third of the rows share every cell
    probes = [rng.choice(18, size=rng.integers(1, 4), replace=False) for _ in range(40)]
    asking = queries_by_cell(probes)
    allowed = [[bool(set(row) & set(probe)) for row in cells] for probe in probes]
    ids = [f"{n}" for n in range(900)]
    got = run(queries, [vectors[:500], vectors[500:]], ids, 7,
              parts=lambda start, size: parts_by_cell(cells[start : start + size], asking))
    want = expected(queries, vectors, ids, 7, allowed=allowed)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in want]


def test_sliced_list_column():
    column = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], pa.list_(pa.float32()))
    np.testing.assert_array_equal(to_matrix(column.slice(1, 2)), [[3, 4], [5, 6]])
    assert to_matrix(column.slice(0, 0), 2).shape == (0, 2)


def test_packed_column():
    matrix = np.random.default_rng(0).normal(size=(50, 7)).astype("float32")
    column = pack(pa.array(matrix.tolist(), pa.list_(pa.float32())))
    assert column.type == pa.binary()
    np.testing.assert_array_equal(to_matrix(column, 7), matrix)
    np.testing.assert_array_equal(to_matrix(column.slice(13, 20)), matrix[13:33])
    np.testing.assert_array_equal(to_matrix(column.cast(pa.large_binary()).slice(1, 2)), matrix[1:3])
    assert to_matrix(column.slice(0, 0), 7).shape == (0, 7)


@pytest.mark.parametrize("bad", [[b"1234", None], [b"123"], [b"1234", b"12345678"]])
def test_bad_packed_vectors(bad):
    with pytest.raises(ValueError, match="vector"):
        to_matrix(pa.array(bad, pa.binary()))


@pytest.mark.parametrize("bad", [[[1.0], None], [[1.0], [None]], [[1.0], [1.0, 2.0]], [[float("nan")]]])
def test_bad_vectors(bad):
    with pytest.raises(ValueError, match="vector"):
        to_matrix(pa.array(bad, pa.list_(pa.float32())))


@pytest.mark.parametrize("by_cell", (False, True))
def test_later_blocks_are_looked_at_in_chunks(monkeypatch, by_cell):
    """Once every query has its rows, only chunks with a high score are looked at, whatever
    the sizes of blocks and query groups; a block that beats all before it is scored in full."""
    rng = np.random.default_rng(7)
    queries = np.abs(rng.normal(size=(2100, 12))).astype("float32")
    vectors = rng.normal(size=(3000, 12)).astype("float32")
    vectors[2500:2800] = np.abs(vectors[2500:2800]) * 9
    vectors[1600] = vectors[44] = vectors[1999]
    blocks = np.split(vectors, [1500, 1911, 1912, 2500])
    ids = [f"id{n}" for n in rng.permutation(len(vectors))]
    row_cells, probed = rng.integers(0, 3, size=(3000, 1)), [np.array([n % 3, 1]) for n in range(2100)]

    def parts(start, count):
        return parts_by_cell(row_cells[start : start + count], queries_by_cell(probed))

    in_full = []
    whole = BestRows._in_tiles

    def noted(self, queries, block, *rest):
        in_full.append(len(block))
        return whole(self, queries, block, *rest)

    monkeypatch.setattr(BestRows, "_in_tiles", noted)
    allowed = [np.isin(row_cells[:, 0], probed[q % 3]) for q in range(3)]
    got = run(queries, blocks, ids, 4, parts=parts if by_cell else None)
    want = expected(queries, vectors, ids, 4, allowed=[allowed[q % 3] for q in range(2100)] if by_cell else None)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in want]
    if not by_cell:
        # The first block of both groups of queries, and the one with the long vectors.
        assert set(in_full) == {1500, 500}


@pytest.mark.parametrize("metric", ("ip", "cosine"))
def test_leaves_spare_scores(monkeypatch, metric):
    """Rows that cannot come up to a query's floor by their main axes are not scored, and the
    rows found are those of brute force: with copies, zero vectors and rows that beat all before."""
    rng = np.random.default_rng(11)
    spread = 0.3 ** np.arange(24)
    vectors = (rng.normal(size=(5000, 24)) * spread).astype("float32")
    vectors[3000:3060], vectors[300], vectors[4001:4200] = vectors[17], 0, vectors[4000]
    queries = np.vstack([vectors[rng.permutation(5000)[:300]], np.zeros((2, 24), "float32")])
    vectors[4700:] *= 30
    monkeypatch.setattr("vecloom.operators.kernel.FIRST_ROWS", 500)
    monkeypatch.setattr("vecloom.operators.kernel.ROW_TILE", 1000)
    monkeypatch.setattr("vecloom.operators.kernel.LEAF_ROWS", 32)
    scored = []
    room = BestRows._room
    monkeypatch.setattr(BestRows, "_room", lambda self, shape, kind: (scored.append(shape[0] * shape[1]), room(self, shape, kind))[1])
    ids = [f"id{n}" for n in rng.permutation(len(vectors))]
    got = run(queries, np.split(vectors, [3003]), ids, 5, metric)
    want = expected(queries, vectors, ids, 5, metric)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in want]
    assert sum(scored) < 0.8 * len(queries) * len(vectors)


@pytest.mark.parametrize("scale", (1e-25, 1.0, 3e13))
def test_leaves_of_any_length(monkeypatch, scale):
    """Bounds hold for very short and very long vectors, and where leaves spare nothing."""
    rng = np.random.default_rng(5)
    queries = rng.normal(size=(60, 20)).astype("float32")
    spread = np.r_[np.ones(6), np.full(14, 0.01)]
    vectors = (rng.normal(size=(3000, 20)) * spread * scale).astype("float32")
    monkeypatch.setattr("vecloom.operators.kernel.FIRST_ROWS", 200)
    monkeypatch.setattr("vecloom.operators.kernel.ROW_TILE", 500)
    monkeypatch.setattr("vecloom.operators.kernel.LEAF_ROWS", 16)
    monkeypatch.setattr("vecloom.operators.kernel.SPARED", -1)
    ids = list(rng.permutation(len(vectors)))
    got = run(queries, np.split(vectors, [1600]), ids, 3)
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in expected(queries, vectors, ids, 3)]


def test_each_query_keeps_what_it_wants():
    """Queries that want fewer rows than others keep only these, copies included."""
    rng = np.random.default_rng(3)
    queries, vectors = rng.normal(size=(90, 12)).astype("float32"), rng.normal(size=(7000, 12)).astype("float32")
    vectors[6000:6100] = vectors[5]
    wanted = rng.integers(1, 21, size=90)
    ids = [f"id{n}" for n in rng.permutation(len(vectors))]
    best = BestRows(queries, 20, wanted=wanted)
    for start in range(0, 7000, 3500):
        best.offer(pa.table({"id": ids[start : start + 3500]}), vectors[start : start + 3500])
    table = best.table()
    assert table.num_rows == best.count() == wanted.sum()
    got = zip(*(table.column(c).to_pylist() for c in ("query", "id", "score")))
    want = [row for q in range(90) for row in expected(queries[q : q + 1], vectors, ids, int(wanted[q]))]
    assert [i for _, i, _ in sorted(got, key=lambda r: (r[0], -r[2], r[1]))] == [i for _, i, _ in want]
