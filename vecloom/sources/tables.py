"""Reading tables, with the small filters that belong next to a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAGRAPH_SCHEMA = T.StructType(
    [
        T.StructField("paragraph_id", T.StringType()),
        T.StructField("article_id", T.LongType()),
        T.StructField("article_title", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
QUERY_SCHEMA = T.StructType(
    [
        T.StructField("paragraph_id", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)


def read_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAGRAPH_SCHEMA).parquet(path)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Stored query vectors; a missing path is an error when the plan is built."""
    return spark.read.schema(QUERY_SCHEMA).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred by one more pass,
    which reads codes such as ``02134`` as numbers; pass a schema to keep them text."""
    reader = spark.read.option("header", "true")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(schema).csv(path)


def where_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Equality filter. A number is compared as text with a text column, so that one
    malformed code does not fail the whole job under ANSI casts."""
    if isinstance(df.schema[column].dataType, T.StringType):
        value = str(value)
    return df.where(F.col(column) == F.lit(value))


def limit_if_positive(df: DataFrame, limit: int, *order: str | Column) -> DataFrame:
    """The first ``limit`` rows in a stated order; 0 keeps all of them."""
    return df.orderBy(*order).limit(limit) if limit > 0 else df


def preview(df: DataFrame, rows: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in df.schema]
