import pytest

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()),
    StructField("lang", StringType()), StructField("source", StringType()),
    StructField("n_chars", LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source), dealt over a few partitions."""

    def make(rows, parts=3):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a",
             len(r[1]) if r[1] is not None else None) for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small_docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in small_docs.collect()]
