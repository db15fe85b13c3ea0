from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("score", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("mix", T.StringType()),
        T.StructField("pii", T.StringType()),
    ]
)
LONG = " ".join(f"word{i % 997}," for i in range(30_000))
CLEAN = " ".join(f"the w{i} of it." for i in range(60))
ROWS = [
    (1, CLEAN, "en", "a", 1),
    (1, CLEAN, "en", "a", 1),
    (2, CLEAN, "xx", None, 1),
    (3, None, None, "b", None),
    (4, "", "fr", "b", 0),
    (None, "one two three", "de", "c", 1),
    (5, LONG, "en", "c", 1),
    (6, "mail a.b@c.org or d@e.f_g@h.i, +1 (017) 555-7713 and 10.0.0.255, card 4111 1111 1111 1111", "en", "c", 1),
]


@pytest.fixture
def odd(spark):
    """Nulls, an empty and a very long text, ties, repeated rows, clashing names."""
    return spark.createDataFrame([(*row, "s", "r", "m", "p") for row in ROWS], DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (4, 0, None), (5, None, 0), (None, 1, 1), (5, 0, 0), (5, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
