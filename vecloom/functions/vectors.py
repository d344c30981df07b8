"""Expressions over ARRAY<FLOAT> columns. Sums run left to right, in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are compared after rounding to this many digits, so that equal vectors get
# equal scores whatever order a kernel adds in, and the id decides between them.
# Float32 input carries about seven digits.
SCORE_DIGITS = 9


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _double(value: Column) -> Column:
    return value.cast("double")


def as_floats(vector: Column | str) -> Column:
    return F.transform(vector, lambda x: x.cast("float"))


def dims(vector: Column | str) -> Column:
    return F.size(vector)


def norm(vector: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(vector, lambda x: _double(x) * _double(x))))


def unit(vector: Column | str) -> Column:
    """The vector at length one; a zero vector stays zero."""
    length = norm(vector)
    return F.when(length == 0, as_floats(vector)).otherwise(
        F.transform(vector, lambda x: F.try_divide(_double(x), length).cast("float"))
    )


def inner_product(left: Column | str, right: Column | str) -> Column:
    return _sum(F.zip_with(left, right, lambda x, y: _double(x) * _double(y)))


def cosine(left: Column | str, right: Column | str) -> Column:
    """Inner product over both lengths; 0 when either vector is zero."""
    return F.coalesce(
        F.try_divide(inner_product(left, right), norm(left) * norm(right)), F.lit(0.0)
    )


def similarity(distance: Column | str) -> Column:
    """Cosine distance (0 = identical) to score (higher = closer)."""
    return F.lit(1.0) - _column(distance)


def similarity_from_euclidean(distance: Column | str) -> Column:
    """Euclidean distance between unit vectors to cosine score."""
    return F.lit(1.0) - _column(distance) * _column(distance) / F.lit(2.0)


def is_complete(vector: Column | str) -> Column:
    """True for a vector that is present and has no missing or non-finite element."""
    limit = F.lit(float("inf"))
    missing = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (x == limit) | (x == -limit))
    return F.coalesce(~missing, F.lit(False))
