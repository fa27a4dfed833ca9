from __future__ import annotations

import pytest

#: Names that the operators use inside; as extra columns they must not matter.
CLASHING = ("key", "print", "node", "root", "a", "b", "words", "hash", "doc", "item", "ids", "sum", "held", "n", "word", "url", "copies", "fingerprint", "component_id", "number", "place")

EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n \r\f\v "),
    (4, "one"),
    (5, "one two three four five six seven eight nine ten"),
    (6, "one two three four five six seven eight nine ten"),
    (6, "one two three four five six seven eight nine ten"),
    (7, "Äh ß é 中文 🎉 mail a.b@c.de or +1 (372) 555-7739 now"),
    (None, "a row without an id"),
    (None, None),
    (8, "word " * 30000),
    (9, "x" * 50000),
    (10, " ".join(f"w{i}" for i in range(20000))),
]


def with_clashes(spark, rows, schema):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    return df.select("*", *(F.lit(c).alias(c) for c in CLASHING if c not in df.columns))


@pytest.fixture(scope="session")
def edge_docs(spark):
    return with_clashes(spark, EDGES, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark, [], "doc_id long, text string")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(sf_dir):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/documents.parquet").to_pandas()
