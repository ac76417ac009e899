import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def slow_resample(docs, target):
    bags = [slow_features(text) for _, text in docs]
    s, t = Counter(), Counter()
    for _, bag in bags:
        s.update(bag)
    for text in target:
        t.update(slow_features(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    rows = []
    for (name, _), (n_words, bag) in zip(docs, bags):
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000))))
            for b in bag
        )
        digest = hashlib.sha256(f"42:{'' if name is None else name}".encode()).hexdigest()
        h = int(digest[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([name, len(bag), weight, score, None, n_words])
    best = sorted(
        (r for r in rows if r[5] >= 20),
        key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]),
    )
    for i, row in enumerate(best[:5 * len(best) // 100]):
        row[4] = i + 1
    return sorted(map(str, rows))


def rows_of(df):
    return sorted(str(list(r)) for r in df.collect())


@pytest.fixture(scope="module")
def target(spark):
    rows = [("alpha beta gamma delta",), (None,), ("Alpha-BETA, gamma",)]
    return spark.createDataFrame(rows, "text string"), [r[0] for r in rows]


@pytest.fixture(scope="module")
def odd_docs():
    rng = random.Random(5)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "ÄÖ", "x1", "don't", "日本", "[a]"])
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(300)]
    same = "alpha beta gamma " * 10
    rows += [(1000, same)] * 90 + [(None, same)] * 30 + [(1001, None), (None, None), (1002, "")]
    rows += [(1003, "y" * 100_000 + " z"), (1004, "alpha beta " * 40_000), (5, same)]
    return rows


@pytest.mark.parametrize("segment_rows", [None, 10, 37])
def test_the_draw_against_brute_force(make_docs, target, odd_docs, segment_rows):
    docs = make_docs(odd_docs, 7)
    for name in ("run", "place", "rank", "weight", "score", "id", "late", "fall", "segment",
                 "eligible", "bucket", "n", "n_words", "n_features"):
        docs = docs.withColumn(name, F.lit(None).cast("string"))
    got = importance.resample(docs, target[0], segment_rows=segment_rows)
    assert rows_of(got) == slow_resample(odd_docs, target[1])


def test_empty_tables(make_docs, target, odd_docs):
    docs = make_docs(odd_docs[:50])
    assert importance.resample(docs.limit(0), target[0]).count() == 0
    got = importance.resample(docs, target[0].limit(0))
    assert rows_of(got) == slow_resample(odd_docs[:50], [])


def test_the_query_against_brute_force(spark, small, small_rows):
    bench = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = importance.op12_importance(spark, small)
    assert rows_of(got) == slow_resample([r[:2] for r in small_rows], bench)


def test_crcs_of_joined_strings():
    rng = random.Random(2)
    crc_of = importance.CrcShift()
    parts = [rng.randbytes(n) for n in (0, 1, 2, 3, 7, 8, 64, 300, 5_000, 70_000)]
    rows = crc_of.rows_of([len(b) for b in parts])
    for a in parts:
        start = np.full(len(parts), zlib.crc32(a), dtype=np.uint32)
        ends = np.array([zlib.crc32(b) for b in parts], dtype=np.uint32)
        assert (crc_of.moved(start, rows) ^ ends).tolist() == [zlib.crc32(a + b) for b in parts]


def test_segments_share_a_hot_score(spark):
    """A third of all rows with one score and one id is still cut into segments."""
    rows = [(i % 97, 7, 0, 5, True) for i in range(600)] + [(1, 7, 0, 9, True)] * 300
    scored = spark.createDataFrame(
        rows, "doc_id bigint, n_features bigint, weight bigint, score bigint, eligible boolean"
    ).repartition(12)
    runs = importance.sorted_runs_of(scored)
    splitters = importance.regular_splitters(runs, 900, 30)
    assert len(splitters) > 20
    ranked = importance.rank_best(runs, 900, 900, 30).orderBy("rank").collect()
    assert [r.rank for r in ranked] == list(range(1, 901))
    assert [(-r.score, r.doc_id) for r in ranked] == sorted((-r[3], r[0]) for r in rows)
