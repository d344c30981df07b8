"""Operator 6: document quality by a linear-chain CRF over lines.

Every line is good or bad. Its features are shares of its characters and words, and the
main ones of the lines before and after it; a 2 x 2 matrix links neighbouring labels.
Forward and backward passes give each line's marginal, and a document's quality is the mean
marginal of its lines, weighted by their length in bytes.

The model is fitted on a bounded sample of labelled documents (SAMPLE_DOCUMENTS, chosen by
a hash of the id, and of each at most SAMPLE_LINES lines in a row from a hashed start):
every line carries its document's label. All lines of all documents are scored.

Null and empty texts are one empty line and get its score. Repeated rows score the same.
Labels that are null are none; of several labels of a document the lowest counts. Without
any label of both kinds all scores are 0.5. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_buffers
from vecloom.llm.words import word_hashes

SAMPLE_DOCUMENTS = 4000
SAMPLE_LINES = 256
CHUNK = 1 << 19
STEPS = 80

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC2, 0xF5)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(0x21, 0x7F) if chr(b) not in ".,;:'\"-()?" and not chr(b).isalnum()]] = True
OWN = 9
FEATURES = 1 + OWN + 2 * OWN + 2


def _share(marked: np.ndarray, edges: np.ndarray, whole: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(marked)][edges]
    return (sums[1:] - sums[:-1]) / np.maximum(whole, 1)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length in bytes, lines of each text) of the lines of some texts."""
    # A space after each text keeps the words of neighbouring texts apart.
    lengths = np.diff(offsets)
    spaced = np.full(len(data) + len(lengths), 0x20, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths)] = data
    data, offsets = spaced, offsets + np.arange(len(offsets))
    marks = np.flatnonzero(data == 0x0A)
    texts = np.searchsorted(offsets, marks, "right") - 1
    # A line begins with its text or after a line feed.
    begin = np.sort(np.r_[offsets[:-1], marks + 1])
    owner = np.sort(np.r_[np.arange(len(offsets) - 1), texts])
    order = np.r_[begin[1:], len(data)]
    stop = np.minimum(order, offsets[owner + 1] - 1)
    edges = np.r_[begin, len(data)]
    size = stop - begin
    letters = np.r_[0, np.cumsum(_LETTER[data])][edges]
    letters = letters[1:] - letters[:-1]
    upper = _UPPER[data]
    if len(data) > 1:
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        upper[:-1] |= second
    starts, word_ends, hashes = word_hashes(data.tobytes())
    line = np.searchsorted(begin, starts, "right") - 1
    many = np.bincount(line, minlength=len(begin))
    same = np.zeros(len(hashes), bool)
    if len(hashes):
        same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    adjacent = np.bincount(line[same], minlength=len(begin)) / np.maximum(many, 1)
    order = np.lexsort((hashes, line))
    again = np.zeros(len(hashes), bool)
    if len(hashes):
        again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])
    repeated = np.bincount(line[order][again], minlength=len(begin)) / np.maximum(many, 1)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(hashes * (np.arange(len(hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))]
        plain = np.r_[np.uint64(0), np.cumsum(hashes)]
        at = np.searchsorted(line, np.arange(len(begin) + 1))
        total, first = plain[at[1:]] - plain[at[:-1]], at[:-1].astype(np.uint64)
        key = sums[at[1:]] - sums[at[:-1]] - total * first * np.uint64(2)
    order = np.lexsort((key, owner))
    twin = np.zeros(len(begin), bool)
    equal = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twin[order[1:]] |= equal
    twin[order[:-1]] |= equal
    word_bytes = np.bincount(line, weights=word_ends - starts, minlength=len(begin))
    own = np.stack(
        [
            np.log1p(many) / 5,
            _share(upper, edges, letters),
            _share(_SIGN[data], edges, many),
            _share(_DIGIT[data], edges, size),
            adjacent,
            np.where(many > 4, repeated, 0.0),
            np.minimum(word_bytes / np.maximum(many, 1) / 10, 3),
            twin & (many > 0),
            many == 0,
        ],
        axis=1,
    ).astype(np.float64)
    fresh = np.r_[True, owner[1:] != owner[:-1]]
    final = np.r_[fresh[1:], True]
    before = np.where(fresh[:, None], 0, np.r_[own[:1] * 0, own[:-1]])
    after = np.where(final[:, None], 0, np.r_[own[1:], own[:1] * 0])
    ones = np.ones((len(own), 1))
    features = np.hstack([ones, own, before, after, fresh[:, None], final[:, None]])
    return features, size, np.bincount(owner, minlength=len(offsets) - 1)


def chain(emission: np.ndarray, lines: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "good" for every line, and the expected links of each text (n x 2 x 2).

    emission: log-odds of good per line; links: 2 x 2 weights from label to label.
    """
    longest = int(lines.max(initial=0))
    order = np.argsort(-lines, kind="stable")
    starts = (np.cumsum(lines) - lines)[order]
    sizes = lines[order]
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    # Scaled by the larger of both labels, so that nothing over- or underflows.
    local = np.exp(np.stack([np.minimum(-emission, 0), np.minimum(emission, 0)], 1))
    weight = np.exp(links - links.max())
    forward = np.zeros((len(emission), 2))
    for t in range(longest):
        n = active[t]
        at = starts[:n] + t
        now = local[at] if t == 0 else local[at] * (forward[at - 1] @ weight)
        forward[at] = now / now.sum(1, keepdims=True)
    backward = np.ones((len(emission), 2))
    expected = np.zeros((len(lines), 2, 2))
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        at = starts[:n] + t
        ahead = local[at + 1] * backward[at + 1]
        now = ahead @ weight.T
        backward[at] = now / now.sum(1, keepdims=True)
        pair = forward[at][:, :, None] * weight * ahead[:, None, :]
        expected[order[:n]] += pair / pair.sum((1, 2), keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(1), expected


def fit(features: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> dict:
    """Weights of the chain by gradient steps on the mean log-likelihood of a line."""
    if len(set(labels.tolist())) < 2:
        return {"weights": np.zeros(FEATURES), "links": np.zeros((2, 2)), "mean": np.zeros(FEATURES), "scale": np.ones(FEATURES)}
    mean, scale = features.mean(0), features.std(0)
    mean[scale < 1e-9], scale[scale < 1e-9] = 0, 1
    x = (features - mean) / scale
    y = np.repeat(labels, lines).astype(float)
    # Both labels and all documents count the same, whatever their number of lines.
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    each = np.repeat(share / np.maximum(lines, 1), lines)
    pairs = np.zeros((len(lines), 2, 2))
    pairs[np.arange(len(lines)), labels, labels] = np.maximum(lines - 1, 0)
    parameters = np.zeros(x.shape[1] + 4)
    slope, spread = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, links = parameters[:-4], parameters[-4:].reshape(2, 2)
        marginal, expected = chain(x @ weights, lines, links)
        gradient = np.r_[
            x.T @ (each * (y - marginal)),
            ((pairs - expected) * (share / np.maximum(lines, 1))[:, None, None]).sum(0).ravel(),
        ]
        gradient -= 1e-3 * parameters
        slope = 0.9 * slope + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        parameters = parameters + 0.15 * (slope / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6)
    return {"weights": parameters[:-4], "links": parameters[-4:].reshape(2, 2), "mean": mean, "scale": scale}


def _chunks(offsets: np.ndarray):
    at, n = 0, len(offsets) - 1
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, upto
        at = upto


def scores(model: dict, column: pa.Array) -> np.ndarray:
    data, offsets = text_buffers(column)
    emission, sizes, lines = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in _chunks(offsets):
        x, size, many = line_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        emission.append((x - model["mean"]) / model["scale"] @ model["weights"])
        sizes.append(size)
        lines.append(many)
    emission, sizes, lines = (np.concatenate(x) for x in (emission, sizes, lines))
    if not len(lines):
        return np.zeros(0)
    marginal, _ = chain(emission, lines, model["links"])
    weight = sizes + 1.0
    starts = np.cumsum(lines) - lines
    return np.add.reduceat(marginal * weight, starts) / np.add.reduceat(weight, starts)


def score(model: dict, text: Column) -> Column:
    """Quality of a text, from 0 to 1."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(scores(model, texts), pa.float64())

    return scored(text)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    documents: int = SAMPLE_DOCUMENTS,
    lines: int = SAMPLE_LINES,
) -> dict:
    """A model from a bounded sample: at most ``documents`` texts of ``lines`` lines."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("sample_id"))
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("sample_id"), "sample_id")
        .limit(documents)
    )

    @F.arrow_udf("array<array<double>>")
    def featured(texts: pa.Array, ids: pa.Array) -> pa.Array:
        found = []
        for i, number in enumerate(ids.to_pylist()):
            data, offsets = text_buffers(texts.slice(i, 1))
            x = line_features(data, offsets)[0]
            at = number % max(1, len(x) - lines + 1)
            found.append(x[at : at + lines].tolist())
        return pa.array(found, pa.list_(pa.list_(pa.float64())))

    # At most `documents` ids: Spark knows that and may broadcast them.
    some = docs.select(F.col(doc_id).alias("sample_id"), F.col(text).alias("text")).join(chosen, "sample_id")
    some = some.dropDuplicates(["sample_id"])
    rows = some.select("sample_id", "label", featured("text", F.xxhash64("sample_id")).alias("x")).collect()
    rows.sort(key=lambda r: r.sample_id)
    x = [np.array(r.x) for r in rows]
    empty = np.zeros((0, FEATURES))
    return fit(
        np.vstack([empty, *x]), np.array([len(a) for a in x], np.int64), np.array([r.label for r in rows], np.int64)
    )


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
