"""Every operator and stage on one awkward table: nulls, long texts, repeats, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clientele.llm import (
    embeddings,
    language,
    mixing,
    packing,
    passages,
    quality,
    simhash,
    suffixes,
    token_counts,
    toxicity,
)

CLASHING = ["id", "uid", "ord", "key", "size", "rate", "p", "n", "block", "spread", "print", "near",
            "_id", "_ord", "_uid", "_turn", "kept", "label", "score", "words", "lines", "length",
            "piece", "copies", "target", "rows", "least", "component_id", "fingerprint", "terms"]


@pytest.fixture(scope="module")
def awkward(make_docs):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    long = " ".join(word() for _ in range(60_000))
    plain = [" ".join(word() for _ in range(80)) for _ in range(12)]
    rows = [(i, t, "en", "a") for i, t in enumerate(plain)]
    rows += [(20, long, "en", "a"), (21, long, "de", None), (22, None, None, None), (23, "", "en", "b"),
             (24, " \n\t", None, "b"), (None, plain[0], "en", "a"), (None, None, None, None),
             (25, "x" * 50_000, "en", "c"), (25, "x" * 50_000, "en", "c"), (0, plain[0], "en", "a"),
             (26, plain[1] + " " + plain[2], "fr", "c"), (27, "same line\n" * 400, "en", "a")]
    docs = make_docs(rows, 4)
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(None if i % 3 else i).cast("string"))
    return docs, len(rows)


@pytest.mark.parametrize("apply", [
    mixing.mix, simhash.simhash_components, token_counts.token_counts, quality.quality_rules,
    suffixes.without_repeated_bytes, passages.repeated_passages,
], ids=lambda f: f.__name__)
def test_one_row_for_each_row(awkward, apply):
    docs, rows = awkward
    assert apply(docs).count() == rows
    assert apply(docs.limit(0)).count() == 0


def test_pieces_scores_and_languages(spark, awkward):
    docs, rows = awkward
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, toxic int")
    pieces = packing.pack(docs)
    assert pieces.where("piece = 0").count() == rows
    assert toxicity.toxicity_scores(docs, labels).count() == rows
    found = language.fuse_languages(
        language.document_evidence(docs), docs.select("lang", "text")
    )
    assert found.count() == rows and found.where("lang IS NULL").count() == 0


def with_clashing(df):
    for i, name in enumerate(CLASHING):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None if i % 3 else i).cast("string"))
    return df


def test_embeddings_beside_clashing_columns(spark):
    rows = [(i, [1.0, 0.01 * (i % 3)], 1) for i in range(9)] + [
        (20, None, 1), (21, [0.0, 0.0], 1), (None, [1.0, 0.0], 1), (22, [1.0, None], None), (0, [1.0, 0.0], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    clash = [c for c in CLASHING if c != "label"]
    for name in (*clash, "vec", "leaf", "tree", "u", "v"):
        vectors = vectors.withColumn(name, F.lit("x"))
    found = embeddings.near_duplicates(vectors)
    assert found.count() == len(rows)
    assert embeddings.near_duplicates(vectors.limit(0)).count() == 0


def test_pages_beside_clashing_columns(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text")
    plain = language.fuse_languages(language.page_evidence(pages), docs)
    clash = language.fuse_languages(language.page_evidence(with_clashing(pages)), docs)
    assert plain.count() == pages.count()
    assert sorted(map(str, plain.collect())) == sorted(map(str, clash.collect()))
    assert language.fuse_languages(language.page_evidence(pages.limit(0)), docs).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1], ids=lambda x: str(x)[:12])
def test_stages_keep_all_columns(spark, awkward, tmp_path, name, stage):
    docs, rows = awkward
    folder = str(tmp_path)
    spark.createDataFrame(
        [(i, int(i == 3)) for i in range(12)], "doc_id bigint, toxic int"
    ).write.parquet(f"{folder}/labels.parquet")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    after = stage(spark, docs, folder)
    assert after.columns == docs.columns and after.schema == docs.schema
    assert 0 < after.count() <= 2 * rows
    assert stage(spark, docs.limit(0), folder).count() == 0
