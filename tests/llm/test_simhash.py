import random

import numpy as np
import xxhash

from clientele.llm import simhash


def slow_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, max_bits=3):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def check(rows, df):
    prints = [slow_print(r[1]) for r in rows]
    group = slow_components(prints)
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted((str(r[0]), p, str(least.get(g))) for r, p, g in zip(rows, prints, group))
    got = simhash.simhash_components(df).collect()
    found = sorted((str(r.doc_id), r.fingerprint % 2**64, str(r.component_id)) for r in got)
    assert found == want


def test_the_small_documents(small_rows, small_docs):
    check(small_rows, small_docs)


def test_nulls_empty_texts_and_repeated_rows(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (4, "One two"), (None, "one TWO"),
            (5, "a b c d"), (6, "a b c d"), (None, "x y z"), (7, "ÄÖ b c")]
    check(rows, make_docs(rows))


def test_an_empty_table(make_docs):
    assert simhash.simhash_components(make_docs([])).count() == 0


def test_edges_find_all_pairs_at_any_list_length(spark, monkeypatch):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for p in base[:6]:
        for _ in range(60):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 4)):
                q ^= 1 << b
            prints.add(q)
    prints = sorted(prints)
    want = slow_components(prints)
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "print bigint")
    for rows in (4096, 16):
        monkeypatch.setattr(simhash, "LIST_ROWS", rows)
        edges = simhash.near_edges(df).collect()
        place = {p: i for i, p in enumerate(prints)}
        parent = list(range(len(prints)))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for e in edges:
            u, v = e.u % 2**64, e.v % 2**64
            assert (u ^ v) and want[place[u]] == want[place[v]]
            parent[root(place[u])] = root(place[v])
        got = [root(i) for i in range(len(prints))]
        assert len(set(got)) == len(set(want))
        assert len(set(zip(got, want))) == len(set(want))


def test_one_document_of_each_group_stays(make_docs):
    docs = make_docs([(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (9, "q r s")])
    kept = sorted(str(r.doc_id) for r in simhash.keep_one_of_each(docs).collect())
    assert kept == ["1", "9", "None"]
