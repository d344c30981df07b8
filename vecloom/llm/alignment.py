"""Operator 12: aligning the tokens of two tokenizers over a corpus.

Each text is encoded by both tokenizers. Byte offsets where a token of both ends cut the text
into groups, and the two tokens that end there are linked. How often the corpus links a pair
of ids says which tokens stand for each other.

Encoding and alignment are one pass over Arrow batches: the id lists are flattened with the
indices of their parents, byte lengths become ends by cumulative sums over each text's
segment, and a hash join on (text, end) in Acero gives the links. The links are written once,
as ids alone. Their counts are partial ``Table.group_by`` counts of each batch, merged by
Spark. Of two tokens that end together one is a suffix of the other, so no more pairs can ever
be linked than the two vocabularies hold suffixes of each other (`possible_pairs`: 324,297 for
the registered query's, 8 MB of counts whatever the corpus), and the counts are shipped to the
tasks in order, which look the links up there.

A long text is cut at letters followed by a space, where both tokenizers always part tokens,
so its arrays come piece by piece; its numbers are added up and its groups hashed one after
another. A text without such a place is taken whole.

Texts that are null or empty, or whose tokens do not spell them (characters that a tokenizer
normalises or cannot show), have no tokens: zeros and an empty string. Repeated rows count as
often as they occur. An empty table gives no rows. Columns other than the id and the text are
carried only if they are named in ``keep``.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_buffers
from vecloom.llm.encoder import Encoder, tokenizer_file
from vecloom.session import settled

# Characters aligned at once; a longer text comes in pieces of about that size.
PIECE = 1 << 17
# Texts of a batch that are held as Python strings at once.
SOME_TEXTS = 250
# Links to a written row.
ROW_LINKS = 1 << 20
# Links whose counts are looked up at once.
SOME_LINKS = 1 << 18
SPACE = "▁"
# Both tokenizers part tokens between the two.
_BREAK = re.compile("[A-Za-z] ")
_WORD = re.compile(" +[^ ]*")
# Words, and fragments of words, whose tokens a worker remembers.
REMEMBERED = 50_000


def id_lists(ids: list, counts: np.ndarray) -> pa.Array:
    """Flat ids and how many each text has, as Arrow lists."""
    ends = np.append(0, np.cumsum(counts))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


class ByteTokens:
    """A byte-level BPE; special tokens are plain text. spec: see ``plain_tokenizer``."""

    def __init__(self, spec: tuple):
        self.encoder = Encoder(*spec)
        self.spelled = self.encoder.token_bytes

    def encode(self, raw: list[bytes]) -> pa.Array:
        if len(self.encoder.known) > REMEMBERED:
            self.encoder.forget()
        data, offsets = text_buffers(pa.array(raw, pa.binary()).cast(pa.string()))
        found = [ids for some in self.encoder.encode_batch(data, offsets) for ids in some]
        values = np.concatenate(found) if found else np.zeros(0, np.uint32)
        return id_lists(values.astype(np.int32), np.array([len(x) for x in found], np.int64))


def plain_tokenizer(path: str) -> tuple:
    """What the tasks need of a byte-level tokenizer file, without its special tokens."""
    content, classes = tokenizer_file(path)
    return json.dumps({**json.loads(content), "added_tokens": []}), classes


class PieceTokens:
    """A sentencepiece model, which puts the space before a text itself.

    No piece holds a space after another character, so a text's ids are those of its words,
    each with the spaces before it; a word is encoded once as long as it is remembered.
    """

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("the model has pieces with a space inside a word")
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        for i in range(len(pieces)):
            if self.model.is_control(i) or self.model.is_unknown(i):
                self.spelled[i] = b""

        self.known: dict[str, list[int]] = {}
        # The library takes a single space for nothing when it is the whole text.
        self.space = [self.model.piece_to_id(SPACE)]

    def encode(self, texts: list[str]) -> pa.Array:
        """The ids of each text; they begin with a space."""
        words = [_WORD.findall(t) for t in texts]
        new = list({w for own in words for w in own}.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:  # starts afresh
            self.known.clear()
            new = list({w for own in words for w in own})
        self.known.update(zip(new, self.model.encode([w[1:] for w in new], num_threads=1), strict=True))
        self.known[" "] = self.space
        ids, counts = [], []
        for own in words:
            before = len(ids)
            ids.extend(chain.from_iterable(map(self.known.__getitem__, own)))
            counts.append(len(ids) - before)
        return id_lists(ids, np.array(counts, np.int64))


def possible_pairs(one: list[bytes], other: list[bytes]) -> int:
    """How many pairs of tokens can end together: one of the two is a suffix of the other."""

    def held(short: list[bytes], long: list[bytes]) -> int:
        known: dict[bytes, int] = {}
        for token in short:
            known[token] = known.get(token, 0) + 1
        return sum(known.get(t[i:], 0) for t in long for i in range(len(t)))

    equal: dict[bytes, int] = {}
    for token in other:
        equal[token] = equal.get(token, 0) + 1
    return held(one, other) + held(other, one) - sum(equal.get(t, 0) for t in one if t)


class Spelling:
    """The bytes of each token, and the ids as text with what may follow them."""

    def __init__(self, spelled: list[bytes], follows: bytes):
        self.lengths = pa.array([len(t) for t in spelled], pa.int64())
        self.tokens = pa.array(spelled, pa.binary())
        self.shown = [str(i).encode() + end for end in (b",", follows) for i in range(len(spelled))]


def joined_bytes(tokens: pa.Array) -> bytes:
    """The bytes of all tokens one after another."""
    _, offsets, data = tokens.buffers()
    if data is None or not len(tokens):
        return b""
    ends = np.frombuffer(offsets, np.int32)[tokens.offset : tokens.offset + len(tokens) + 1]
    return data.to_pybytes()[ends[0] : ends[-1]]


class Side:
    """The tokens of some texts: flat ids, the text of each and its end in that text."""

    def __init__(self, lists: pa.Array, spelling: Spelling):
        self.ids = pc.list_flatten(lists)
        self.parents = pc.list_parent_indices(lists)
        self.starts = lists.offsets.to_numpy().astype(np.int64)
        self.spelling = spelling
        total = np.append(0, pc.cumulative_sum(spelling.lengths.take(self.ids)).to_numpy())
        self.sizes = np.diff(total[self.starts])
        self.ends = total[1:] - total[self.starts[:-1]][self.parents.to_numpy()]

    def spells(self, texts: list[bytes]) -> np.ndarray:
        """Which texts the tokens spell."""
        raw = joined_bytes(self.spelling.tokens.take(self.ids))
        if raw == b"".join(texts) and self.sizes.tolist() == list(map(len, texts)):
            return np.ones(len(texts), bool)
        ends = np.append(0, np.cumsum(self.sizes)).tolist()
        return np.array([raw[a:b] == t for a, b, t in zip(ends, ends[1:], texts, strict=False)])

    def table(self, name: str) -> pa.Table:
        return pa.table({"text": self.parents, "end": self.ends, name: np.arange(len(self.ids))})


class Aligner:
    def __init__(self, byte_spec: tuple, piece_file: bytes):
        self.one, self.other = ByteTokens(byte_spec), PieceTokens(piece_file)
        self.a, self.b = Spelling(self.one.spelled, b"|"), Spelling(self.other.spelled, b";")
        self.shown = pa.array(self.a.shown + self.b.shown, pa.binary())

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, int, bytes, np.ndarray] | None]:
        """For each text (tokens of each kind, groups, groups as text, links as a << 32 | b);
        None if its tokens do not spell it."""
        if not texts:
            return
        texts = [f" {t}" for t in texts]
        raw = [t.encode() for t in texts]
        ids = self.one.encode(raw), self.other.encode(texts)
        a, b = Side(ids[0], self.a), Side(ids[1], self.b)
        good = a.spells(raw) & b.spells(raw)
        if not good.all():
            a, b = (Side(i.filter(pa.array(good)), s) for i, s in zip(ids, (self.a, self.b), strict=True))
        ends = a.table("a").join(b.table("b"), ["text", "end"], join_type="inner", use_threads=False).sort_by("a")
        last_a, last_b = ends["a"].to_numpy(), ends["b"].to_numpy()
        links = a.ids.take(ends["a"]).to_numpy().astype(np.int64) << 32 | b.ids.take(ends["b"]).to_numpy()
        shown, places = self.groups(a, b, last_a, last_b)
        first = np.searchsorted(last_a, a.starts)
        done = iter(range(len(a.sizes)))
        for ok in good:
            if not ok:
                yield None
                continue
            i = next(done)
            n_a, n_b = int(a.starts[i + 1] - a.starts[i]), int(b.starts[i + 1] - b.starts[i])
            begin, end = places[a.starts[i] + b.starts[i]], places[a.starts[i + 1] + b.starts[i + 1]]
            own = links[first[i] : first[i + 1]]
            yield n_a, n_b, len(own), shown[begin : end - 1], own

    def groups(self, a: Side, b: Side, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, and the place there of each token in turn."""
        n_a, n_b = len(a.ids), len(b.ids)
        each = np.empty(n_a + n_b, np.int64)
        closing = np.zeros(n_a, np.int64)
        closing[last_a] = len(self.a.lengths)
        group = np.searchsorted(last_a, np.arange(n_a))
        each[np.arange(n_a) + np.append(0, last_b + 1)[group]] = a.ids.to_numpy() + closing
        closing = np.zeros(n_b, np.int64)
        closing[last_b] = len(self.b.lengths)
        group = np.searchsorted(last_b, np.arange(n_b))
        each[np.arange(n_b) + last_a[group] + 1] = b.ids.to_numpy() + closing + len(self.a.shown)
        tokens = self.shown.take(pa.array(each))
        offsets = np.frombuffer(tokens.buffers()[1], np.int32)[: len(tokens) + 1] if len(tokens) else np.zeros(1, int)
        return joined_bytes(tokens), offsets


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that both tokenizers encode by themselves, each without the space
    before it."""
    at = 0
    while len(text) - at > PIECE:
        place = _BREAK.search(text, at + PIECE)
        if place is None:
            break
        yield text[at : place.start() + 1]
        at = place.end()
    yield text[at:]


class Total:
    """What is known of a text so far."""

    def __init__(self) -> None:
        self.spelled = True
        self.counts = np.zeros(3, np.int64)
        self.hash = hashlib.sha256()
        self.links: list[np.ndarray] = []

    def add(self, part: tuple[int, int, int, bytes, np.ndarray] | None) -> None:
        if part is None:
            self.spelled, self.links = False, []
        elif self.spelled:
            if self.links:
                self.hash.update(b";")
            self.counts += part[:3]
            self.hash.update(part[3])
            self.links.append(part[4])

    def rows(self) -> list[tuple]:
        """(part, parts, n_a, n_b, n_groups, groups_sha256, links): the links in parts."""
        if not self.spelled or not self.links:
            return [(0, 1, 0, 0, 0, "", np.zeros(0, np.int64))]
        links = np.concatenate(self.links)
        cut = [links[at : at + ROW_LINKS] for at in range(0, len(links), ROW_LINKS)]
        return [(i, len(cut), *self.counts.tolist(), self.hash.hexdigest(), some) for i, some in enumerate(cut)]


def aligned(aligner: Aligner, texts: list[str | None]) -> Iterator[list[tuple]]:
    """The rows of each text, in order."""
    totals: list[Total] = []
    waiting: list[str] = []
    owners: list[Total] = []
    size = 0

    def settle() -> None:
        for total, part in zip(owners, aligner.align(waiting), strict=True):
            total.add(part)
        waiting.clear()
        owners.clear()

    for text in texts:
        totals.append(Total())
        for piece in pieces(text) if text else ():
            waiting.append(piece)
            owners.append(totals[-1])
            size += len(piece)
            if size >= PIECE:
                settle()
                size = 0
                # All but the text in hand are done.
                yield from (t.rows() for t in totals[:-1])
                del totals[:-1]
    settle()
    yield from (t.rows() for t in totals)


_made: dict[int, Aligner] = {}


def let_go() -> None:
    """Encoding is over: the worker gives up its tokenizers and the memory they held."""
    if _made:
        _made.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def worker_aligner(byte_spec: tuple, piece_file: bytes) -> Aligner:
    """One aligner for each worker process and pair of tokenizers."""
    key = hash((byte_spec[0], piece_file))
    if key not in _made:
        _made.clear()
        _made[key] = Aligner(byte_spec, piece_file)
    return _made[key]


FIELDS = {
    "part": pa.int32(),
    "parts": pa.int32(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "groups_sha256": pa.string(),
    "links": pa.list_(pa.int64()),
}


def listed(texts: list[list[tuple]]) -> pa.Array:
    """The rows of each text as Arrow lists."""
    rows = [row for own in texts for row in own]
    columns = zip(*rows, strict=True) if rows else [[]] * len(FIELDS)
    arrays = [pa.array(list(x), kind) for x, kind in zip(columns, FIELDS.values(), strict=True)]
    ends = np.cumsum([0, *map(len, texts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, list(FIELDS)))


def alignments(text: Column, byte_spec: tuple, piece_file: bytes) -> Column:
    """The rows of a text (see ``Total.rows``) as an array."""
    kinds = "part:int,parts:int,n_a:bigint,n_b:bigint,n_groups:bigint,groups_sha256:string,links:array<bigint>"

    @F.arrow_udf(f"array<struct<{kinds}>>")
    def align(texts: pa.Array) -> pa.Array:
        aligner = worker_aligner(byte_spec, piece_file)
        found = [listed([])]
        for at in range(0, len(texts), SOME_TEXTS):
            found.append(listed(list(aligned(aligner, texts.slice(at, SOME_TEXTS).to_pylist()))))
        return pa.concat_arrays(found)

    return align(text)


def link_counts(rows: DataFrame) -> pa.Table:
    """(link, n, best) for every pair of ids that is linked: how often, and whether no other pair
    of its B id is linked more often. At most `possible_pairs` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total = pa.table({"link": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        for batch in batches:
            links = pa.table({"link": pc.list_flatten(batch.column(0))})
            some = links.group_by("link", use_threads=False).aggregate([([], "count_all")])
            some = some.rename_columns(["link", "n"])
            both = pa.concat_tables([total, some.select(["link", "n"])])
            total = both.group_by("link", use_threads=False).aggregate([("n", "sum")]).rename_columns(["link", "n"])
        yield from total.to_batches()

    partial = rows.select("links").mapInArrow(count, "link bigint, n bigint")
    found = partial.groupBy("link").agg(F.sum("n").alias("n")).toArrow().combine_chunks()
    own = found.append_column("b", pc.bit_wise_and(found["link"], pa.scalar(0xFFFFFFFF, pa.int64())))
    most = own.group_by("b").aggregate([("n", "max")])
    own = own.join(most, "b")
    return own.append_column("best", pc.equal(own["n"], own["n_max"]).cast(pa.int64())).select(["link", "n", "best"])


def with_counts(links: Column, counts: pa.Table) -> Column:
    """(n_best, count_sum) of a list of links."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, counts.schema) as out:
        out.write_table(counts.sort_by("link"))
    packed = sink.getvalue().to_pybytes()

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint>")
    def look_up(lists: pa.Array) -> pa.Array:
        let_go()
        known = worker_counts(packed)
        ends = np.append(0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy()))
        flat = lists.flatten().to_numpy()
        # Running sums to each place, SOME_LINKS of them at a time.
        sums = np.zeros((2, len(flat) + 1), np.int64)
        for at in range(0, len(flat), SOME_LINKS):
            place = np.searchsorted(known[0], flat[at : at + SOME_LINKS])
            for own, figures in zip(sums, known[1:], strict=True):
                own[at + 1 : at + 1 + len(place)] = np.cumsum(figures[place]) + own[at]
        found = np.diff(sums[:, ends], axis=1)
        return pa.StructArray.from_arrays([pa.array(found[0]), pa.array(found[1])], ["n_best", "count_sum"])

    return look_up(links)


_counts: dict[int, tuple[np.ndarray, ...]] = {}


def worker_counts(packed: bytes) -> tuple[np.ndarray, ...]:
    """Links in order, whether each is a best one, and how often it is linked."""
    key = hash(packed)
    if key not in _counts:
        _counts.clear()
        known = pa.ipc.open_stream(packed).read_all()
        _counts[key] = tuple(known[name].to_numpy() for name in ("link", "best", "n"))
    return _counts[key]


def align(
    docs: DataFrame,
    byte_tokenizer: str,
    piece_model: str,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, *keep, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every
    document. byte_tokenizer (A) and piece_model (B) are paths of tokenizer files."""
    byte_spec = plain_tokenizer(byte_tokenizer)
    with open(piece_model, "rb") as file:
        piece_file = file.read()
    made = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.struct(F.lit(0).alias("_"), *keep).alias("others"),
        F.explode(alignments(F.col(text), byte_spec, piece_file)).alias("t"),
    )
    made = settled(made.select("row", "doc_id", "others", "t.*"), "links")
    counted = made.withColumn("found", with_counts(F.col("links"), link_counts(made)))
    counted = counted.withColumn("n_links", F.size("links").cast("long")).select("*", "found.*")
    same = ["doc_id", "others", "n_a", "n_b", "n_groups", "groups_sha256"]
    sums = ["n_links", "n_best", "count_sum"]
    # Only texts of several parts meet again.
    long = counted.where("parts > 1").groupBy("row").agg(
        *(F.first(c).alias(c) for c in same), *(F.sum(c).alias(c) for c in sums)
    )
    found = counted.where("parts = 1").select(*same, *sums).unionByName(long.select(*same, *sums))
    return found.select(
        "doc_id", *(F.col("others")[c].alias(c) for c in keep), *same[2:5], *sums, "groups_sha256"
    )
