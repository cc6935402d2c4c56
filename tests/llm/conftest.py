"""Small tables and helpers for these tests."""

import pandas as pd
import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Build a documents table from (id, text[, lang]) rows."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very short, very long, mixed scripts, marks, repeated rows."""
    long = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 2500
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "Ünïcödé ÄÖÜ 漢字 \U0001f600 é İ"),
        (6, "x" * 5000), (7, long), (7, long), (None, "no id here"), (8, "<|endoftext|> mid<|startoftext|>dle"),
        (9, "tab\tnl\nff\fvt\vcr\rnbsp em end"), (10, "don't we've I'M 12345 $$$ ###"), (10, "another text under a used id"),
    ]


@pytest.fixture(scope="session")
def real_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pandas_rows(df, key="doc_id"):
    frame = df.toPandas()
    return frame.sort_values(list(frame.columns[:1]), kind="stable").reset_index(drop=True)


def by_text(df, id_col="doc_id"):
    return {r[id_col]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="session")
def items(spark):
    schema = StructType([StructField("item_id", LongType()), StructField("text", StringType())])

    def build(rows):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def labels_of(spark):
    schema = StructType([StructField("doc_id", LongType()), StructField("toxic", IntegerType())])
    return lambda rows: spark.createDataFrame(rows, schema)


__all__ = ["DOCS", "SF", "by_text", "pandas_rows", "pd"]
