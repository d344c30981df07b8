"""Text expressions: whitespace, blank checks, lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; all of them lie below U+3001.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column | str) -> Column:
    """Remove outer whitespace, Unicode spaces and separators included."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def keep_texts(df: DataFrame, text: str) -> DataFrame:
    """Strip the text column and drop the rows it leaves empty."""
    return df.withColumn(text, strip(text)).where(F.col(text) != "")


def reject_blank(df: DataFrame, text: str, message: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into usable ones and blank ones; the latter carry an ``error``."""
    blank = is_blank(text)
    return df.where(~blank), df.where(blank).withColumn("error", F.lit(message))


def lines(text: Column | str) -> Column:
    """The stripped, non-empty lines of a text, in order."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")
