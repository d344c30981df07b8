"""Hash buckets of all runs of one to three words, over many texts at once.

The checksum of "one two" follows from those of its words by the rule for joined CRCs: the
first is carried over as many zero bytes as the second has, then both are xor-ed. So each
word's bytes are read once, in C, and everything after is array work on 32-bit numbers.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np

LONGEST_RUN = 3
# Words handled at once, and bytes of a text split at once.
WORDS = 200_000
BYTES = 1 << 20
# Carrying over up to so many bytes is one table; beyond it goes by powers of two.
CARRIED = 64
_CRC32 = 0xEDB88320
# A-Z in lower case; other ASCII but digits and letters parts words.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def _carry_one(crc: np.ndarray) -> np.ndarray:
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(_CRC32), crc >> 1)
    return crc


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0, crc & 255] ^ table[1, crc >> 8 & 255] ^ table[2, crc >> 16 & 255] ^ table[3, crc >> 24]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each of the four bytes of a checksum its value after n zero bytes: for n up to
    CARRIED, and for the powers of two."""
    bytes_of = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    few = [bytes_of]
    for _ in range(CARRIED):
        few.append(_carry_one(few[-1]))
    powers = [few[1]]
    for _ in range(40):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(few), np.stack(powers)


def carried(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The checksums after n zero bytes each."""
    few, powers = _tables()
    small = np.minimum(n, CARRIED)
    found = np.zeros(len(crc), np.uint32)
    for k in range(4):
        found ^= few[small, k, crc >> np.uint32(8 * k) & np.uint32(255)]
    for i in np.flatnonzero(n > CARRIED):
        rest, one = int(n[i]) - CARRIED, found[i : i + 1]
        for k in range(rest.bit_length()):
            if rest >> k & 1:
                one = _apply(powers[k], one)
        found[i] = one[0]
    return found


def run_crcs(words: list[bytes], text: np.ndarray, seen: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, CRC-32) of the runs that end at each word but the first ``seen``, a run's words
    joined by one space. text: the number of the text that a word belongs to."""
    n = len(words)
    own = np.fromiter(map(zlib.crc32, words), np.uint32, n)
    length = np.fromiter(map(len, words), np.int64, n)
    spaced = carried(np.full(n, zlib.crc32(b" "), np.uint32), length) ^ own
    ends, found, run = [text[seen:]], [own[seen:]], own
    for k in range(1, LONGEST_RUN):
        run = carried(run[:-1], 1 + length[k:]) ^ spaced[k:]
        whole = text[k:] == text[:-k]
        whole[: max(0, seen - k)] = False
        ends.append(text[k:][whole])
        found.append(run[whole])
    return np.concatenate(ends), np.concatenate(found)


def parts(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    plain = raw.translate(_PLAIN)
    at = 0
    while at < len(plain):
        stop = plain.find(b" ", at + BYTES) if len(plain) - at > BYTES else len(plain)
        stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


def runs(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, CRC-32) of all runs and the text of each word, for some words at a time. A text
    may come in several goes; texts are numbered from 0."""
    words: list[bytes] = []
    owner: list[np.ndarray] = []
    seen = 0
    for number, raw in enumerate(texts):
        for part in parts(raw):
            words += part
            owner.append(np.full(len(part), number))
            if len(words) >= WORDS:
                text = np.concatenate(owner)
                yield (*run_crcs(words, text, seen), text[seen:])
                # The runs that end in the text's next words need its last ones.
                last = words[1 - LONGEST_RUN :]
                of = text[1 - LONGEST_RUN :]
                words = [w for w, t in zip(last, of, strict=True) if t == number]
                seen = len(words)
                owner = [np.full(seen, number)]
    if len(words) > seen:
        text = np.concatenate(owner)
        yield (*run_crcs(words, text, seen), text[seen:])
