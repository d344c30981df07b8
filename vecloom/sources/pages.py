"""Articles out of XML page dumps and HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.text import keep_texts, strip

_RECORD = "_title STRING, extract ARRAY<STRUCT<_VALUE: ARRAY<STRING>>>"


def read_xml_articles(spark: SparkSession, path: str) -> DataFrame:
    """``(title, extract)`` of every ``<page title=..><extract>..</extract></page>``.

    The files are read as text records that end in ``</page``, with or without space
    before the ``>``. Such a scan splits at any byte offset, so one large dump is read by
    many tasks; a file-at-a-time XML reader would put it into one. Pages may sit at any
    depth, also inside one another. Of several extracts the first counts, of its text what
    stands before its first child element; a page without such text is dropped. A page
    that is not well formed fails the job, and so does one whose extract follows a page
    nested in it, since the two may lie in different records.
    """
    raw = spark.read.option("lineSep", "</page").text(path)
    alone = F.regexp_replace("value", r"<page(\s[^>]*)?/>", "")
    opened = F.filter(F.split(alone, r"(?=<page[\s>])"), lambda p: p.rlike(r"^<page[\s>]"))
    pieces = raw.select(opened.alias("pieces")).select(
        F.posexplode("pieces").alias("place", "piece"), (F.size("pieces") - 1).alias("last")
    )
    # The last page opened in a record is the one that ends it; those before it hold it.
    head = F.regexp_extract("piece", r"(?s)^(<page[\s>].*?(?:</extract\s*>|<extract(?:\s[^>]*)?/>))", 1)
    late = F.raise_error(F.lit("a page's extract follows a page nested in it"))
    page = F.when(F.col("place") == F.col("last"), F.col("piece")).otherwise(F.when(head != "", head).otherwise(late))
    opens_with_child = F.regexp_extract("page", r"(?s)<extract(?:\s[^>]*)?>(\s*<[^!/])?", 1) != ""
    parsed = (
        pieces.select(page.alias("page"))
        .where(~opens_with_child)
        .select(
            F.from_xml(
                F.concat("page", F.lit("</page>")), _RECORD, {"mode": "FAILFAST"}
            ).alias("p")
        )
    )
    first = F.get("p.extract", F.lit(0))
    return keep_texts(
        parsed.select(
            F.col("p._title").alias("title"),
            F.get(first["_VALUE"], F.lit(0)).alias("extract"),
        ),
        "extract",
    )


def to_xml_records(title: str, text: str) -> Column:
    """One ``<page>`` record per row, for writing a dump as text files."""

    def escaped(column: str) -> Column:
        plain = F.replace(F.col(column).cast("string"), F.lit("&"), F.lit("&amp;"))
        plain = F.replace(plain, F.lit("<"), F.lit("&lt;"))
        return F.replace(plain, F.lit('"'), F.lit("&quot;"))

    return F.concat(
        F.lit('<page title="'), escaped(title), F.lit('"><extract>'), escaped(text),
        F.lit("</extract></page>"),
    )


def html_titles(pages: DataFrame, html: str = "html") -> DataFrame:
    """The ``<title>`` of raw HTML, which is not XML and needs no tree here."""
    title = strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.withColumn("title", title)
