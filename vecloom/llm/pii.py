"""Operator 2: personal data by weak supervision, in DataFrame operations only.

Candidates are the spans of fixed patterns (the base) and of wider ones (person names,
national ids, IBANs). Four labelers vote on each: its form, a gazetteer, the words before
it and what touches it; a vote is for, against or none. Expectation-maximisation estimates
how reliable each labeler is, without labels. It needs only how often each combination of
kind, votes and length class occurs, a table of at most KINDS x 81 x 3 rows, which is
counted over all documents. A logistic span classifier is then trained on the expected
labels. Base spans stay whatever it says; wider ones are added if it accepts them, a labeler
beside their form is for them and none against, and they touch no base span.

Patterns are written so that a failing run of characters is tried once, not from each of its
characters, and so that no repeated group recurses. Places are code points.

A null text is empty and has no spans. Texts are taken whole; repeated rows give the same
spans. Ties (spans of one start) go by the order of the kinds. An empty table gives no rows.
Columns named in ``keep`` are carried, the others are not.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import spans_text
from vecloom.session import settled

BASE = ("email", "ip", "card", "phone")
WIDER = ("person", "national_id", "iban")
KINDS = BASE + WIDER
LABELERS = 4
ACCEPTED = 0.9
CONTEXT = 40

LOCAL = "A-Za-z0-9._%+-"
GIVEN_NAMES = (
    "James|John|Robert|Michael|William|David|Richard|Joseph|Thomas|Charles|Daniel|Matthew|Anthony|Steven|"
    "Mary|Patricia|Jennifer|Linda|Elizabeth|Barbara|Susan|Jessica|Sarah|Karen|Margaret|Emily|Michelle|"
    "Pierre|Jacques|Philippe|Nathalie|Isabelle|Sylvie|Hans|Klaus|Jürgen|Wolfgang|Günter|Ursula|Monika|"
    "José|Carlos|Miguel|Javier|Francisco|Guadalupe|Fernando|Alejandro"
)
TITLES = r"Mr|Mrs|Ms|Dr|Prof|Dear|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Contact|Attn"
PATTERNS = {
    # A match begins where a run of its characters does, or right after the last match.
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Whole runs of 14 to 19 digits; other runs fail in any case.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:(?<=(?:{TITLES})\.? )|(?={GIVEN_NAMES}\b))"
    r"\p{Lu}\p{Ll}{1,19} \p{Lu}\p{Ll}{1,19}(?![\p{L}\p{N}])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?+(?![0-9A-Za-z])",
}
FOUND = "array<struct<start:int,place:int,kind:string,end:int,votes:int>>"


def _hits(text: Column, pattern: str) -> Column:
    """(start, end, span, the words before, the character after) of each match.

    The text between matches gives their places; both arrays are bound to a lambda's
    variable, so that they are made once per text.
    """
    parts = F.struct(
        F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("spans")
    )
    hit = "struct<start:int,end:int,span:string,before:string,after:string>"
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{hit}>").alias("out"))

    def walk(p: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            before, span = F.get(p["between"], i), F.get(p["spans"], i)
            start = state["at"] + F.length(before)
            end = start + F.length(span)
            found = F.struct(
                start.alias("start"),
                end.alias("end"),
                span.alias("span"),
                F.lower(F.right(before, F.lit(CONTEXT))).alias("before"),
                F.left(F.get(p["between"], i + 1), F.lit(1)).alias("after"),
            )
            return F.struct(end.alias("at"), F.array_append(state["out"], found).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(p["spans"]) - 1), nothing, add, lambda s: s["out"])

    walked = F.get(F.transform(F.array(parts), walk), F.lit(0))
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(f"array<{hit}>"))


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"
        return span.rlike(rf"^(?:{part}\.){{3}}{part}$")
    if kind == "card":
        return _luhn(_digits(span))
    if kind == "phone":
        return F.length(_digits(span)).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    against = F.lit(1) if no is None else F.when(no, 0).otherwise(1)
    return F.when(yes, 2).otherwise(against)


def _votes(kind: str, hit: Column) -> Column:
    """The four votes (0 against, 1 none, 2 for) and the length class as one number."""
    span, before, after = hit["span"], hit["before"], hit["after"]
    form = {
        "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@.*\.[A-Za-z]{2,}$",
        "ip": r"^[1-9][0-9]*(?:\.(?:0|[1-9][0-9]*)){3}$",
        "card": r"^[3-6]",
        "phone": r"^\+[1-9]",
        "person": r"^\p{Lu}\p{Ll}{2,} \p{Lu}\p{Ll}{2,}$",
        "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
        "iban": r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
    }[kind]
    known = {
        "email": _vote(span.rlike(r"\.(?:com|org|net|edu|gov|de|fr|es|uk|io)$"), span.rlike("^(?:no-?reply|info|admin)@")),
        "ip": _vote(F.lit(False), span.rlike(r"^(?:0|10|127|192\.168|255|22[4-9]|23[0-9])\.")),
        "card": _vote(span.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"), span.rlike(r"^([0-9])(?:[ -]?\1)+$")),
        "phone": _vote(span.rlike(r"^\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-58])")),
        "person": _vote(span.rlike(f"^(?:{GIVEN_NAMES}) "), span.rlike(r"^(\p{L}+) \1$")),
        "national_id": _vote(F.lit(False), span.isin("123-45-6789", "078-05-1120")),
        "iban": _vote(F.length(F.regexp_replace(span, " ", "")).between(15, 34)),
    }[kind]
    cues = {
        "email": "mail|contact|write|kontakt|courriel|correo",
        "ip": r"\bip\b|address|server|host|login|from ",
        "card": "card|visa|credit|payment|karte|carte|tarjeta",
        "phone": "phone|tel|call|mobile|fax|contact|cell",
        "person": rf"(?:{TITLES.lower()}|name|signed|author|by)[ .:]*$",
        "national_id": "ssn|social security|national id|tax id",
        "iban": "iban|account|bank|konto|compte|cuenta",
    }[kind]
    misleading = r"version|isbn|issn|doi|serial|order no|figure|section|chapter|part number"
    votes = [
        _vote(span.rlike(form), ~span.rlike(form)),
        known,
        _vote(before.rlike(cues), before.rlike(misleading)),
        _vote(F.lit(False), after.rlike(r"[\p{L}\p{N}_]") | before.rlike(r"[\p{L}\p{N}_]$")),
    ]
    length = F.when(F.length(span) < 12, 0).when(F.length(span) < 24, 1).otherwise(2)
    code = reduce(lambda total, vote: total * 3 + vote, [*votes, length], F.lit(KINDS.index(kind)))
    return code.cast("int")


def _spans(text: Column, kind: str) -> Column:
    def span(hit: Column) -> Column:
        return F.struct(
            hit["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("place"),
            F.lit(kind).alias("kind"),
            hit["end"].alias("end"),
            _votes(kind, hit).alias("votes"),
        )

    return F.transform(F.filter(_hits(text, PATTERNS[kind]), lambda hit: _valid(kind, hit["span"])), span)


def candidates(text: Column) -> dict[str, Column]:
    """For each kind, its spans (start, place of the kind, kind, end, votes) in a text."""
    text = F.coalesce(text, F.lit(""))
    some = {
        "email": F.contains(text, F.lit("@")),
        "phone": F.contains(text, F.lit("+")),
        "person": F.lit(True),
    }
    found = {}
    for kind in KINDS:
        likely = some.get(kind, text.rlike("[0-9]"))
        found[kind] = F.when(likely, _spans(text, kind)).otherwise(F.array().cast(FOUND))
    return found


def _unpack(code: int) -> tuple[int, tuple[int, ...], int]:
    code, length = divmod(code, 3)
    votes = []
    for _ in range(LABELERS):
        code, vote = divmod(code, 3)
        votes.append(vote)
    return code, tuple(reversed(votes)), length


def reliabilities(counts: dict[int, int], rounds: int = 30) -> dict[int, float]:
    """EM over (kind, votes): the expected label of each combination.

    Each labeler has one reliability, the chance that a vote of it is right; no vote says
    nothing. Each kind has a share of true spans. Both start from, and are held back by, a
    prior: a labeler is right four times in five, half of a kind's candidates are true.
    """
    right = [0.8] * LABELERS
    shares = dict.fromkeys(range(len(KINDS)), 0.5)
    expected: dict[int, float] = {}
    total = sum(counts.values())
    for _ in range(rounds):
        for code in counts:
            kind, votes, _ = _unpack(code)
            odds = math.log(shares[kind] / (1 - shares[kind]))
            odds += sum((v - 1) * math.log(r / (1 - r)) for v, r in zip(votes, right, strict=True))
            expected[code] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        strength = 1.0 + 0.1 * total
        agreed, cast = [0.8 * strength] * LABELERS, [strength] * LABELERS
        true, seen = dict.fromkeys(shares, 0.0), dict.fromkeys(shares, 0)
        for code, n in counts.items():
            kind, votes, _ = _unpack(code)
            true[kind] += n * expected[code]
            seen[kind] += n
            for j, v in enumerate(votes):
                if v != 1:
                    cast[j] += n
                    agreed[j] += n * (expected[code] if v == 2 else 1 - expected[code])
        right = [min(0.99, max(0.5, a / c)) for a, c in zip(agreed, cast, strict=True)]
        shares = {k: (true[k] + 0.5 + 0.25 * seen[k]) / (1.5 * seen[k] + 1) for k in shares}
    return expected


def span_classifier(counts: dict[int, int], expected: dict[int, float], rounds: int = 200) -> dict[int, float]:
    """Logistic regression on the expected labels; the probability of each combination."""

    def features(code: int) -> list[str]:
        kind, votes, length = _unpack(code)
        return ["all", f"kind {kind}", f"length {length}", *(f"{j} {v}" for j, v in enumerate(votes) if v != 1)]

    # Logarithmic weights: common combinations must not drown the rare ones.
    weight = {code: math.log1p(n) for code, n in counts.items()}
    total = sum(weight.values()) or 1.0
    weights: dict[str, float] = defaultdict(float)

    def probability(code: int) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(weights[f] for f in features(code))))))

    for _ in range(rounds):
        slope: dict[str, float] = defaultdict(float)
        for code, w in weight.items():
            error = expected[code] - probability(code)
            for f in features(code):
                slope[f] += w * error / total
        for f, value in slope.items():
            weights[f] += 2.0 * (value - 1e-4 * weights[f])
    return {code: probability(code) for code in counts}


def _supported(code: int) -> bool:
    """Whether a wider span has a vote beyond its form, and none against it."""
    kind, votes, _ = _unpack(code)
    return kind >= len(BASE) and 2 in votes[1:] and 0 not in votes


def find(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, others, n per base kind, base, spans): others holds the columns of ``keep``."""
    found = df.select(
        F.col(doc_id).alias("doc_id"),
        F.struct(F.lit(0).alias("_"), *keep).alias("others"),
        *(spans.alias(kind) for kind, spans in candidates(F.col(text)).items()),
    )
    found = settled(found, "candidates")
    # At most KINDS x 81 x 3 rows reach the driver.
    votes = found.select(F.explode(F.concat(*KINDS)).alias("c")).groupBy("c.votes").count().collect()
    counts = {r.votes: r["count"] for r in votes}
    sure = span_classifier(counts, reliabilities(counts))
    added = [c for c, p in sure.items() if p >= ACCEPTED and _supported(c)]
    accepted = F.array(*(F.lit(c) for c in added)).cast("array<int>")
    based = found.select(
        "doc_id",
        "others",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.array_sort(F.concat(*BASE)).alias("base"),
        F.concat(*WIDER).alias("wider"),
    )
    fits = F.filter(
        "wider",
        lambda w: F.array_contains(accepted, w["votes"])
        & ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )
    return based.withColumn("spans", F.array_sort(F.concat("base", fits))).drop("wider")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span as [KIND]; overlapping spans become one, named by the first."""
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], between, mark)).otherwise(state["out"]).alias("out"),
        )

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, nothing, add, rest))


def digests(found: DataFrame) -> DataFrame:
    """What the query returns of ``find``."""
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in BASE),
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
