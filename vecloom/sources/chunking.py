"""Articles to paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.text import lines


def to_paragraphs(
    articles: DataFrame, article_id: str, text: str, title: str | None = None
) -> DataFrame:
    """One row per non-empty line, numbered within its article from 0.

    Splitting, stripping and numbering happen inside the article's own row, so the
    stage is a narrow scan: no shuffle, no window, and one long article costs only
    its own task.
    """
    number = F.col(article_id).cast("bigint")
    name = F.col(title) if title else F.lit(None).cast("string")
    return articles.select(
        number.alias("article_id"),
        name.alias("article_title"),
        F.posexplode(lines(text)).alias("position", "text"),
    ).select(
        F.concat_ws("_", F.col("article_id"), F.col("position")).alias("paragraph_id"),
        "article_id",
        "article_title",
        "text",
    )
