import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyboard.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # names the operators use inside
        T.StructField("id", T.StringType()),
        T.StructField("key", T.IntegerType()),
        T.StructField("n", T.StringType()),
        T.StructField("name", T.ArrayType(T.LongType())),
        T.StructField("h", T.StringType()),
        T.StructField("body", T.MapType(T.StringType(), T.LongType())),
        T.StructField("size", T.StringType()),
        T.StructField("_h", T.StringType()),
    ]
)
LONG = " ".join(f"wort{i % 977} stück{i}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, " \t\n ", "de", "b"),
    (6, LONG, "de", "c"),
    (7, LONG, None, "c"),
    (8, "12 34 .. 56", "en", "a"),
    (None, "Ein Satz ohne Nummer, aber mit Worten", "de", None),
    (9, "gleich", "de", "a"),
    (9, "gleich", "de", "a"),
    (10, "Straße Ärger", "de", "Ä"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    table(spark, SF, "region")
    extra = ("x", 1, "y", [1], "z", {"a": 1}, "s", "t")
    return spark.createDataFrame([(*r, *extra) for r in ROWS], DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("doc_id < -1")


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
