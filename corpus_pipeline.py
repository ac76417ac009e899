"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before wrote. A document that the toxicity score rejects goes, one
document of each SimHash group stays, passages that an earlier document holds are cut out, the
sources are mixed to their target weights, and the rest is packed.

Nulls, ties and repeats: a null text is empty in every stage. A document without an id stays unless
it is toxic, and counts as a document of its own; of rows that share an id one stays. Groups keep
their smallest id, a passage stays where the smallest id has it, equal documents are mixed and
packed in the order of a hash. Texts of any length pass whole, other columns pass unchanged, and an
empty table passes as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientele.llm.common import store
from clientele.llm.mixing import mixed_documents
from clientele.llm.packing import pack
from clientele.llm.passages import without_repeats
from clientele.llm.simhash import keep_one_of_each
from clientele.llm.toxicity import without_toxic


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("passages", passages),
    ("mixing", mixing),
    ("packing", packing),
]

#: No SQL: scores, fingerprints, sampling and packing are beyond it. tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
