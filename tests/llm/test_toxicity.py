import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from clientele.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return (spark.read.parquet(f"{folder}/documents.parquet"),
            spark.read.parquet(f"{folder}/labels.parquet"))


def test_held_out_documents_are_told_apart(tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.op10_toxicity(docs.sparkSession, "/root/testdata/sf0.01").collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    toxic = [p for t, p in judged if t]
    clean = [p for t, p in judged if not t]
    assert toxic and sum(toxic) >= 0.6 * len(toxic)
    assert sum(clean) <= 0.02 * len(clean)


def test_the_block_index_finds_the_nearest_of_all():
    rng = random.Random(4)
    scale = np.array([1 + rng.random() * 4 for _ in range(60)])
    examples = []
    for i in range(700):
        terms = sorted(rng.sample(range(60), rng.randint(0, 6)))
        examples.append((i, int(rng.random() < 0.3), terms, [rng.randint(1, 5) for _ in terms]))
    index = toxicity.build_index(examples, scale, np.zeros(60, dtype=bool))

    def unit(terms, counts):
        v = np.zeros(60)
        for t, c in zip(terms, counts):
            v[t] = (1 + math.log(c)) * scale[t]
        return v / np.linalg.norm(v) if v.any() else v

    vectors = np.array([unit(t, c) for *_, t, c in examples if t])
    for _ in range(60):
        terms = np.array(sorted(rng.sample(range(60), rng.randint(1, 8))))
        counts = np.array([float(rng.randint(1, 4)) for _ in terms])
        _, got = index.nearest(terms, counts, 15)
        cosines = np.sort(vectors @ unit(terms, counts))[::-1]
        want = cosines[cosines > 1e-12][:15]
        assert np.allclose(got, want)


def _by_brute_force(docs, labels):
    """Scores of all (id, text) by comparing each text with every example."""
    bags = {i: Counter(re.findall(r"\w+", (t or "").lower())) for i, t in docs}
    train = {i: y for i, y in labels.items() if i in bags and zlib.crc32(str(i).encode()) % 5}
    sides = [sum(y == s for y in train.values()) for s in (0, 1)]
    held = [Counter(), Counter()]
    for i, y in train.items():
        held[y].update(bags[i].keys())

    def gain(term):
        a, b = held[0][term], held[1][term]
        n = sum(sides)
        g2 = sum(2 * o * math.log(o * n / (r * c)) for o, r, c in (
            (a, sides[0], a + b), (b, sides[1], a + b),
            (sides[0] - a, sides[0], n - a - b), (sides[1] - b, sides[1], n - a - b)) if o)
        return math.sqrt(g2) if a + b >= 5 and g2 >= 20 else 1.0

    terms = {t: gain(t) for t in held[0].keys() | held[1].keys()}
    both = {i: {t: n for t, n in bags[i].items() if t in terms} for i in bags}
    count = Counter(t for bag in both.values() for t in bag)
    idf = {t: math.log((1 + len(docs)) / (1 + count[t])) + 1 for t in terms}

    def unit(i):
        v = {t: (1 + math.log(n)) * idf[t] * terms[t] for t, n in both[i].items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = {i: unit(i) for i in bags}
    rate = sum(train.values()) / len(train)
    marks = {t for t in terms if terms[t] > 1 and held[1][t] * sides[0] > held[0][t] * sides[1]}
    blank = [y for i, y in train.items() if not marks & both[i].keys()]
    found = {}
    for i in bags:
        near = [(sum(x * vectors[j].get(t, 0) for t, x in vectors[i].items()), j) for j in train]
        near = sorted((-round(c, 12), j) for c, j in near if c > 0)[:15]
        votes = sum(-c * train[j] for c, j in near) + 0.5 * rate
        found[i] = votes / (sum(-c for c, _ in near) + 0.5) if near else (
            (sum(blank) + 0.5 * rate) / (len(blank) + 0.5))
    return found


def test_scores_are_the_vote_of_the_nearest_of_all_examples(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = _by_brute_force(list(texts.items()), truth)
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert {r.id for r in rows} == set(want)
    for r in rows:
        assert r.score == pytest.approx(want[r.id], abs=1e-6)
        assert all(zlib.crc32(str(i).encode()) % 5 and i in truth for i in r.neighbours)


def test_nearly_every_text_has_neighbours(tables):
    docs, labels = tables
    rows = toxicity.toxicity_scores(docs, labels).collect()
    empty = {r.doc_id for r in docs.collect() if not re.search(r"\w", r.text or "")}
    assert sum(not r.neighbours for r in rows if r.id not in empty) < 0.01 * len(rows)


def test_nulls_repeats_and_missing_labels(spark, make_docs):
    rows = [(i, "you idiot number " + "ab"[i % 2] if i % 3 == 0 else "a fine day") for i in range(120)]
    rows += [(200, None), (201, ""), (None, "an idiot"), (None, None), (202, "idiot"), (202, "idiot")]
    labels = spark.createDataFrame(
        [(i, 1 if i % 3 == 0 else 0) for i in range(120)] + [(5, None), (None, 1), (999, 1)],
        "doc_id bigint, toxic int",
    )
    got = toxicity.toxicity_scores(make_docs(rows), labels).collect()
    assert len(got) == len(rows)
    score = {}
    for r in got:
        score.setdefault(r.id, set()).add(round(r.score, 9))
    assert min(score[202]) > 0.9 and len(score[202]) == 1
    assert max(score[200]) < 0.1 and score[200] == score[201]
    none = toxicity.toxicity_scores(make_docs(rows), labels.where("false")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity_scores(make_docs([]), labels).count() == 0
    left = toxicity.without_toxic(make_docs(rows), labels, make_docs(rows))
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(i) for i, t in rows if t is None or "idiot" not in t)
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_terms_and_examples_come_to_the_driver_as_columns(spark):
    texts = [" ".join(f"w{n}x{i}" for i in range(1_000)) for n in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id bigint, toxic int")
    tracemalloc.start()
    rows = toxicity.toxicity_scores(docs, labels).collect()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(rows) == 40
    # As objects, the terms, their counts and the postings of the examples take some 15 MB.
    assert peak < 8 << 20
