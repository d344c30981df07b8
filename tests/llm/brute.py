"""Plain versions of the operators, for small tables."""

import hashlib
import re

import numpy as np
import xxhash


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def repeats(rows, window=20):
    """(id, words, removed, digest) of the kept words; rows are (id, text)."""
    last = 2**63
    rows = [(last if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for at, _, words in rows:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, (at, i)), (at, i))
    out = []
    for at, doc_id, words in rows:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (at, i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, words=5):
    parts = (text or "").lower().split()
    if len(parts) < words:
        return {" ".join(parts)}
    return {" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)}


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    sums = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            sums[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * sums[bit] > len(shingles))


def simhash(rows, radius=2):
    prints = [fingerprint(t) for _, t in rows]
    groups = Groups()
    for i, a in enumerate(prints):
        groups.find(i)
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                groups.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = groups.find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(groups.find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))]


def usable(vector):
    return vector is not None and None not in vector and np.isfinite(vector).all()


def cosine_links(rows, threshold=0.9):
    """(id, links, component) for rows (id, vector) of distinct ids."""
    groups = Groups()
    links = dict.fromkeys((i for i, _ in rows), 0)
    good = [(i, np.array(v, float)) for i, v in rows if usable(v) and np.any(v)]
    for x, (i, a) in enumerate(good):
        for j, b in good[:x]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return [(i, links[i], groups.find(i)) for i, _ in rows]


def best_scores(rows, asked, k=20, scale=64):
    out = []
    whole = [(i, [int(x) for x in np.floor(scale * np.array(v, float))]) for i, v in rows if i is not None and usable(v)]
    for i, a in whole:
        if asked(i):
            found = [(-sum(p * q for p, q in zip(a, b, strict=True)), j) for j, b in whole if j != i and len(a) == len(b)]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(found)[:k])]
    return out


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def personal(text):
    """Sorted base spans (start, place, kind, end)."""
    found = []
    patterns = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    for place, (kind, pattern) in enumerate(patterns):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), place, kind, m.end()))
    return sorted(found)


def written(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
