"""Byte-level BPE by certain cuts, over whole Arrow batches.

A byte pair that no token of the vocabulary holds can never be merged over, so the text
may be cut there before anything is merged: the merges left and right of such a place
never see each other. Together with the cuts of the tokenizer's own word splitting this
leaves short fragments. Equal fragments get equal ids, so each distinct fragment of a
worker is encoded once, by the tokenizers library, and the ids of a text are the ids of its
fragments one after another.

Cuts, fragment keys and the gathering of ids are array operations on the UTF-8 bytes. A
fragment key is a 64-bit hash; callers compare the decoded bytes with the text, which
would show a collision.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pandas as pd
import tiktoken
from tokenizers import Regex, Tokenizer
from tokenizers.normalizers import Replace

from vecloom.llm.common import text_buffers

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# Bytes handled at once; arrays of about 60 times this size live at the same time.
CHUNK = 1 << 20
# Fragments remembered by a worker before it starts afresh.
REMEMBERED = 400_000
SEPARATOR = " "


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte (fixed by that format)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def letter_classes() -> list[tuple[int, int]]:
    """Runs (first code point, class) of the letters, numbers and white space that the
    word splitting tells apart, asked from the library's own patterns: other libraries
    follow other versions of Unicode."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    classes = np.full(0x110000, OTHER, np.uint8)
    for at in range(0, len(points), 1 << 16):
        text = "".join(map(chr, points[at : at + (1 << 16)]))
        for pattern, name in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
            rest = Replace(Regex(pattern), "").normalize_str(text)
            if len(rest) < len(text):
                left = np.frombuffer(rest.encode("utf-32-le"), np.uint32)
                whole = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                classes[np.setdiff1d(whole, left, assume_unique=True)] = name
    first = np.flatnonzero(np.diff(classes, prepend=255))
    return list(zip(first.tolist(), classes[first].tolist(), strict=True))


def tokenizer_file(path: str) -> tuple[str, list[tuple[int, int]]]:
    """What the tasks need of a tokenizer file: its text and its letter classes."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    spec = json.loads(text)
    splitting = spec["pre_tokenizer"] or {}
    plain = splitting.get("type") == "ByteLevel" and splitting.get("use_regex", True)
    if not plain or splitting.get("add_prefix_space") or spec["normalizer"] or spec["model"].get("ignore_merges"):
        raise ValueError(f"{path} is not a plain byte-level BPE")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} has added tokens that swallow their surroundings")
    merged = [spec["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    return text, letter_classes()


class Encoder:
    def __init__(self, spec_text: str, classes: list[tuple[int, int]]):
        spec = json.loads(spec_text)
        self.whole = Tokenizer.from_str(spec_text)
        self.whole.no_truncation()
        self.whole.no_padding()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        vocabulary = spec["model"]["vocab"]
        size = max([*vocabulary.values(), *added.values()]) + 1
        self.token_bytes = [b""] * size
        inside = np.zeros((256, 256), bool)
        for token, number in vocabulary.items():
            raw = bytes(byte_of[c] for c in token)
            self.token_bytes[number] = raw
            pairs = np.frombuffer(raw, np.uint8)
            inside[pairs[:-1], pairs[1:]] = True
        for token, number in added.items():
            self.token_bytes[number] = token.encode()
        self.certain = ~inside
        self.added = {token.encode(): number for token, number in added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.token_lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.pieces = tiktoken.Encoding(
            "fragments",
            pat_str=r"(?s:.+)",
            mergeable_ranks={self.token_bytes[i]: i for i in vocabulary.values()},
            special_tokens={},
        )._core_bpe.encode_single_piece
        starts = np.array([s for s, _ in classes])
        values = np.array([v for _, v in classes], np.uint8)
        self.classes = np.repeat(values, np.diff(np.append(starts, 0x110000)))
        random = np.random.default_rng(20)
        self.byte_values = random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.base = 0x9E3779B97F4A7C15 | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverse_powers = np.ones(0, np.uint64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.found_ids = np.zeros(1 << 16, np.uint32)
        self.found_ends = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _grow(self, n: int) -> None:
        if len(self.powers) >= n:
            return
        with np.errstate(over="ignore"):
            self.powers = np.multiply.accumulate(np.r_[1, np.full(n, self.base, np.uint64)].astype(np.uint64))
            self.inverse_powers = np.multiply.accumulate(
                np.r_[1, np.full(n, self.inverse, np.uint64)].astype(np.uint64)
            )

    def _char_classes(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        lead = data[first]
        classes = self.classes[lead]
        wide = np.flatnonzero(lead >= 0x80)
        if len(wide):
            place, b0 = first[wide], lead[wide].astype(np.int64)
            padded = np.r_[data, np.zeros(3, np.uint8)]
            b1, b2, b3 = (padded[place + i].astype(np.int64) & 0x3F for i in (1, 2, 3))
            points = np.select(
                [b0 < 0xE0, b0 < 0xF0],
                [(b0 & 0x1F) << 6 | b1, (b0 & 0x0F) << 12 | b1 << 6 | b2],
                (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3,
            )
            classes[wide] = self.classes[points]
        return classes

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where fragments begin. starts: where a text begins; each is cut on its own."""
        n = len(data)
        alone = np.zeros(n + 1, bool)
        alone[starts[starts <= n]] = True
        fixed = []
        if self.added_pattern and any(token[:2] in data.tobytes() for token in self.added):
            raw = data.tobytes()
            for found in self.added_pattern.finditer(raw):
                if not alone[found.start() + 1 : found.end()].any():
                    fixed.append(found.span())
        for start, end in fixed:
            alone[start] = alone[end] = True
        first = np.flatnonzero((data & 0xC0) != 0x80)
        classes = self._char_classes(data, first)
        fresh = alone[first]
        lead = data[first]
        before = np.r_[np.uint8(255), classes[:-1]]
        begins = fresh | (classes != before)
        # The last space of a run goes with the word after it, any other white space does not.
        word = np.flatnonzero((classes != SPACE) & (before == SPACE) & ~fresh)
        begins[word - 1] = True
        begins[word[lead[word - 1] == 0x20]] = False
        marks = np.flatnonzero(begins & (lead == 0x27))
        if len(marks):
            ends = np.r_[lead, np.zeros(3, np.uint8)]
            stop = np.r_[fresh, True, True, True]
            one, two = ends[marks + 1], ends[marks + 2]
            inside = ~stop[marks + 1]
            short = inside & np.isin(one, np.frombuffer(b"stmd", np.uint8))
            pair = np.stack([one, two])
            long = np.zeros(len(marks), bool)
            for tail in (b"re", b"ve", b"ll"):
                long |= (pair == np.frombuffer(tail, np.uint8)[:, None]).all(0)
            long &= inside & ~stop[marks + 2]
            begins = np.r_[begins, False, False, False]
            for chosen, length in ((short, 2), (long & ~short, 3)):
                begins[marks[chosen] + 1] = False
                begins[marks[chosen] + length] = True
            begins = begins[: len(first)]
        cut = np.zeros(n, bool)
        cut[first] = begins
        if n > 1:
            cut[1:] |= self.certain[data[:-1], data[1:]]
        cut |= alone[:n]
        for start, end in fixed:
            cut[start + 1 : end] = False
        return np.flatnonzero(cut)

    def _learn(self, fragments: list[bytes], keys: list[int]) -> None:
        found = [[self.added[f]] if f in self.added else self.pieces(f) for f in fragments]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
        while self.used + len(ids) > len(self.found_ids):
            self.found_ids = np.r_[self.found_ids, np.zeros_like(self.found_ids)]
        known = len(self.known)
        while known + len(fragments) + 1 > len(self.found_ends):
            self.found_ends = np.r_[self.found_ends, np.zeros_like(self.found_ends)]
        self.found_ids[self.used : self.used + len(ids)] = ids
        self.found_ends[known + 1 : known + 1 + len(fragments)] = self.used + np.cumsum(counts)
        self.used += len(ids)
        self.known.update(zip(keys, range(known, known + len(fragments)), strict=True))

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the place of each text in them."""
        if len(self.known) > REMEMBERED:
            self.forget()
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = self.cuts(data, offsets[:-1])
        lengths = np.diff(np.append(starts, len(data)))
        self._grow(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.byte_values[data] * self.powers[: len(data)], out=sums[1:])
            keys = (sums[starts + lengths] - sums[starts]) * self.inverse_powers[starts]
        codes, distinct = pd.factorize(keys)
        distinct = distinct.tolist()
        place = np.fromiter(map(self.known.get, distinct, [-1] * len(distinct)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        if len(new):
            some = np.zeros(len(distinct), np.int64)
            some[codes[::-1]] = np.arange(len(codes))[::-1]
            where = some[new]
            raw = data.tobytes()
            spans = zip(starts[where].tolist(), (starts[where] + lengths[where]).tolist(), strict=True)
            known = len(self.known)
            self._learn([raw[s:e] for s, e in spans], [distinct[i] for i in new.tolist()])
            place[new] = known + np.arange(len(new))
        place = place[codes]
        begin = self.found_ends[place]
        many = self.found_ends[place + 1] - begin
        ends = np.cumsum(many)
        gather = np.arange(ends[-1]) + np.repeat(begin - (ends - many), many)
        ids = self.found_ids[gather]
        if not np.array_equal(self.decode_bytes(ids), data):  # two fragments shared a key
            return self.encode_plainly(data, offsets)
        # Fragments never cross texts, so a text's ids end where its last fragment's do.
        return ids, np.r_[0, ends][np.searchsorted(starts, offsets, "left")]

    def encode_plainly(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[s:e].decode() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
        found = [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        ends = np.cumsum([0, *map(len, found)])
        return np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1])), ends

    def encode_batch(self, data: np.ndarray, offsets: np.ndarray):
        """Yield (ids, first text, texts) in pieces; a very long text comes in several.

        A long text is cut between a visible ASCII letter and white space, where the word
        splitting always cuts too.
        """
        at, n = 0, len(offsets) - 1
        while at < n:
            upto = int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1
            upto = max(upto, at + 1)
            begin, end = int(offsets[at]), int(offsets[upto])
            if end - begin <= 2 * CHUNK:
                ids, places = self.encode_texts(data[begin:end], offsets[at : upto + 1] - begin)
                yield [ids[places[i] : places[i + 1]] for i in range(upto - at)]
            else:
                parts = []
                while begin < end:
                    stop = min(end, begin + CHUNK)
                    if stop < end:
                        stop = self._break(data, begin, stop, end)
                    parts.append(self.encode_texts(data[begin:stop], np.array([0, stop - begin]))[0])
                    begin = stop
                yield [np.concatenate(parts)]
            at = upto

    @staticmethod
    def _break(data: np.ndarray, begin: int, stop: int, end: int) -> int:
        while True:
            window = data[begin:stop]
            space = (window == 0x20) | (window == 0x0A)
            seen = (window > 0x20) & (window < 0x7F)
            places = np.flatnonzero(space[1:] & seen[:-1])
            if len(places) and places[-1] + 1 > 0:
                return begin + int(places[-1]) + 1
            if stop == end:
                return end
            stop = min(end, stop + (stop - begin))

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The UTF-8 bytes of the tokens, one after another."""
        lengths = self.token_lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.all_bytes[np.arange(total) + np.repeat(self.token_starts[ids] - (ends - lengths), lengths)]

    def encode_column(self, column):
        """The ids of each text of a string column, in order; null is empty."""
        data, offsets = text_buffers(column)
        for piece in self.encode_batch(data, offsets):
            yield from piece


_made: dict[int, Encoder] = {}


def worker_encoder(spec: tuple[str, list[tuple[int, int]]]) -> Encoder:
    """One encoder for each worker process and tokenizer."""
    key = hash(spec[0])
    if key not in _made:
        _made.clear()
        _made[key] = Encoder(*spec)
    return _made[key]
