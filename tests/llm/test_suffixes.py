import hashlib
import random

import duckdb
import numpy as np
import pytest

from clientele.llm import suffixes

NO = suffixes.NO_ID


def slow(rows, length):
    texts = [(NO if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for ids, data in texts:
        for s in range(len(data) - length + 1):
            key = data[s:s + length]
            first[key] = min(first.get(key, (NO, NO)), (ids, s))
    out = []
    for ids, data in texts:
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - length + 1):
            if first[data[s:s + length]] < (ids, s):
                gone[s:s + length] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(data, dtype=np.uint8)[~gone])
        out.append((ids, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df, **more):
    rows = suffixes.without_repeated_bytes(df, **more).collect()
    return sorted((r.ord, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def test_two_stage_sorting_gives_the_suffix_array():
    rng = random.Random(1)
    for letters in ("a", "ab", "abcdefg", "tion the "):
        for n in (1, 2, 7, 60, 400):
            data = bytes(rng.choices(letters.encode(), k=n))
            want = sorted(range(n), key=lambda i: data[i:])
            got = suffixes.two_stage_suffix_array(np.frombuffer(data, dtype=np.uint8), n + 8)
            assert got.tolist() == want
            some = np.array(sorted(rng.sample(range(n), n // 2)), dtype=np.int64)
            part = suffixes.two_stage_suffix_array(np.frombuffer(data, dtype=np.uint8), n + 8, some)
            chosen = set(some.tolist())
            assert [i for i in part.tolist() if i in chosen] == [i for i in want if i in chosen]


def test_common_prefixes():
    rng = random.Random(2)
    data = bytes(rng.choices(b"ab\xc3\xa4", k=3000))
    keys = suffixes._words(np.frombuffer(data + bytes(8), dtype=np.uint8)).byteswap()
    a = np.array([rng.randrange(2800) for _ in range(4000)])
    b = np.array([rng.randrange(2800) for _ in range(4000)])
    b[:200] = a[:200]
    got = suffixes.common_prefixes(keys, a, b, 20)
    for x, y, n in zip(a.tolist(), b.tolist(), got.tolist()):
        want = next((k for k in range(20) if data[x + k] != data[y + k]), 20)
        assert n == want


def test_the_small_documents(small_rows, small_docs):
    assert found(small_docs) == slow(small_rows, 100)


@pytest.mark.parametrize("many, parts", [(1000, 1), (1000, 8), (2, 4)])
def test_shared_passages_ties_nulls_and_repeated_rows(make_docs, monkeypatch, many, parts):
    monkeypatch.setattr(suffixes, "MANY", many)
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäß", k=rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(12) for _ in range(5)]
    rows = []
    for i in range(50):
        parts_ = [text(rng.randint(0, 8)), rng.choice(passages), text(rng.randint(0, 8))]
        if i % 4 == 0:
            parts_.insert(1, rng.choice(passages)[rng.randint(0, 30):])
        rows.append((rng.choice([*range(40), None]), " ".join(parts_)))
    rows += [rows[0], (60, rows[1][1]), (61, None), (62, ""), (63, "z" * 500), (64, "xy" * 200),
             (65, "z" * 90), (-3, passages[0])]
    docs = make_docs(rows, parts)
    assert found(docs, length=40) == slow(rows, 40)


def test_texts_and_an_empty_table(make_docs):
    line = "the quick brown fox jumps over the lazy dog and runs away from it all again"
    docs = make_docs([(1, "a " + line), (2, line + " b")])
    kept = {r.ord: r.kept for r in suffixes.without_repeated_bytes(docs, length=40, texts=True).collect()}
    assert kept == {1: None, 2: b" b"}
    assert found(make_docs([])) == []


def test_the_sql_agrees(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = con.execute(suffixes.SQL)
    names = [c[0] for c in want.description]
    got = suffixes.op8_suffixes(spark, small).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
