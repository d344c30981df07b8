import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vecloom.functions import text
from vecloom.sources import chunking, pages, tables


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_strip_equals_python_for_every_character(spark):
    codes = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    rows = [(c, f"{chr(c)}a{chr(c)}") for c in codes]
    out = frame(spark, rows, "code int, t string").select("t", text.strip("t").alias("s")).collect()
    assert all(r.s == r.t.strip() for r in out)


@pytest.mark.parametrize("value", ["", "  ", " ", "\t\n", "\x1c", "　", None])
def test_blank_texts(spark, value):
    row = frame(spark, [(value,)], "t string").select(text.is_blank("t").alias("b")).first()
    assert row.b is True


def test_text_is_not_blank(spark):
    assert frame(spark, [(" a ",)], "t string").select(text.is_blank("t")).first()[0] is False


def test_keep_texts_strips_and_drops_blank(spark):
    df = frame(spark, [(1, " a "), (2, " "), (3, None), (4, "b")], "id int, t string")
    assert [tuple(r) for r in text.keep_texts(df, "t").orderBy("id").collect()] == [(1, "a"), (4, "b")]


def test_chunking_edges(spark):
    docs = [
        (1, "one"),
        (2, "\n\na\n \n \nb \n"),
        (3, "  \n\t"),
        (4, ""),
        (5, "x\r\ny"),
    ]
    out = chunking.to_paragraphs(frame(spark, docs, "id long, body string"), "id", "body")
    got = {(r.paragraph_id, r.text) for r in out.collect()}
    assert got == {("1_0", "one"), ("2_0", "a"), ("2_1", "b"), ("5_0", "x"), ("5_1", "y")}


def test_chunking_is_narrow(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = chunking.to_paragraphs(docs, "doc_id", "text", "source")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_paragraph_ids_are_unique(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = chunking.to_paragraphs(docs, "doc_id", "text")
    assert out.count() == out.select("paragraph_id").distinct().count()


XML = """<?xml version="1.0"?>
<pages>
<page title="plain"><extract> p &lt; q &amp; r </extract></page>
<page title="mixed"><extract>head <i>inner</i> tail</extract></page>
<page title="leading"><extract><i>inner</i> tail</extract></page>
<page title="empty"><extract/></page>
<page title="blank"><extract>    </extract></page>
<page title="missing"><other>x</other></page>
<section><part><page title="nested"><extract>deep</extract></page></part></section>
<page><extract>untitled</extract></page>
<page title="cdata"><extract><![CDATA[x < y]]></extract></page>
<page title="two
lines"><extract>a
b</extract></page>
</pages>
"""


def test_xml_articles(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(XML, encoding="utf-8")
    out = {r.extract: r.title for r in pages.read_xml_articles(spark, str(tmp_path)).collect()}
    assert out == {
        "p < q & r": "plain",
        "head": "mixed",
        "deep": "nested",
        "untitled": None,
        "x < y": "cdata",
        "a\nb": "two lines",
    }


def test_xml_large_file_is_split(spark, tmp_path):
    body = "".join(
        f'<page title="t{i}"><extract>{"word " * 200}{i}</extract></page>\n' for i in range(2000)
    )
    (tmp_path / "dump.xml").write_text(f"<pages>{body}</pages>", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        out = pages.read_xml_articles(spark, str(tmp_path))
        assert out.rdd.getNumPartitions() > 4
        assert out.select("title").distinct().count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_xml_fails(spark, tmp_path):
    (tmp_path / "dump.xml").write_text('<page title="a"><extract>x</page>')
    with pytest.raises(Exception, match="(?i)malformed"):
        pages.read_xml_articles(spark, str(tmp_path)).collect()


def test_csv_inferred_and_explicit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,zipcode\nann,78727\nbob,02134\ncy,\ndee,78727\n")
    inferred = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(inferred.dtypes)["zipcode"] == "int"
    assert tables.where_equal(inferred, "zipcode", 78727).count() == 2
    stated = tables.read_csv(spark, str(tmp_path / "a.csv"), "name string, zipcode string")
    assert tables.where_equal(stated, "zipcode", "02134").count() == 1


def test_malformed_code_does_not_fail_the_filter(spark, tmp_path):
    (tmp_path / "b.csv").write_text("name,zipcode\nann,78727 TX\nbob,78727\n")
    df = tables.read_csv(spark, str(tmp_path / "b.csv"))
    assert dict(df.dtypes)["zipcode"] == "string"
    assert [r.name for r in tables.where_equal(df, "zipcode", 78727).collect()] == ["bob"]


def test_limit_only_if_positive(spark):
    df = spark.range(10).orderBy(F.desc("id"))
    assert [r.id for r in tables.limit_if_positive(df, 3, "id").collect()] == [0, 1, 2]
    assert tables.limit_if_positive(df, 0, "id").count() == 10


def test_schema_and_preview(spark):
    df = spark.range(5)
    assert tables.schema_rows(df) == [("id", "bigint")]
    assert [r.id for r in tables.preview(df, 2, F.desc("id")).collect()] == [4, 3]


def test_missing_queries_are_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_queries(spark, str(tmp_path / "none"))


def test_filters_and_columns_reach_the_scan(spark, sf):
    df = tables.where_equal(spark.read.parquet(f"{sf}/customer.parquet"), "c_nationkey", 7)
    plan = df.select("c_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_nationkey,7)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def read_dump(spark, tmp_path, text):
    (tmp_path / "dump.xml").write_text(text, encoding="utf-8")
    rows = pages.read_xml_articles(spark, str(tmp_path)).collect()
    return sorted((r.title, r.extract) for r in rows)


def test_nested_xml_pages_are_all_read(spark, tmp_path):
    dump = """<pages><page title="a"><extract>A</extract>
      <page title="b"><extract>B</extract><page title="c"><extract>C</extract></page ></page></page
      ><page title="d"/><page title="e"><extract>E</extract></page></pages>"""
    assert read_dump(spark, tmp_path, dump) == [("a", "A"), ("b", "B"), ("c", "C"), ("e", "E")]


def test_first_extract_of_an_xml_page_counts(spark, tmp_path):
    dump = """<pages><page title="a"><extract>one</extract><extract>two</extract></page>
      <page title="b"><extract/><extract>two</extract></page>
      <page title="c"><extract>x<b>y</b></extract><extract><b>z</b></extract></page></pages>"""
    assert read_dump(spark, tmp_path, dump) == [("a", "one"), ("c", "x")]


def test_an_extract_after_a_nested_page_fails(spark, tmp_path):
    dump = '<page title="a"><page title="b"><extract>B</extract></page><extract>late</extract></page>'
    with pytest.raises(Exception, match="follows a page nested"):
        read_dump(spark, tmp_path, dump)
