import hashlib
import random

import duckdb
import pytest

from clientele.llm import passages


def slow(rows, window):
    first = {}
    texts = [(NO if i is None else i, (t or "").encode().split()) for i, t, *_ in rows]
    for ids, words in texts:
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            first[key] = min(first.get(key, NO), ids)
    out = []
    for ids, words in texts:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < ids:
                gone.update(range(s, s + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((ids, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


NO = passages.NO_ID


def found(df, **more):
    rows = passages.repeated_passages(df, **more).collect()
    return sorted((r.ord, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def test_the_small_documents(small_rows, small_docs):
    assert found(small_docs) == slow(small_rows, 50)


@pytest.mark.parametrize("parts", [1, 8])
def test_short_windows_ties_nulls_and_repeated_rows(make_docs, parts):
    rng = random.Random(3)
    words = ["a", "b", "c", "Ä"]
    rows = [(rng.choice([*range(30), None]), " ".join(rng.choices(words, k=rng.randint(0, 40))))
            for _ in range(60)]
    # A row key tells rows of one id apart, so an id may come again with another text.
    rows += [rows[0], (31, None), (32, ""), (33, "a\tb\n c  d"), (-4, " ".join(["a"] * 50))]
    docs = make_docs(rows, parts)
    got = found(docs, window=9, period=7, cover=(1, 2, 4))
    assert got == slow(rows, 9)


def test_texts_follow_and_emptied_documents_go(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(1, text), (2, text), (3, "one  two\n" + text + "  end"), (4, "kept  as\nit is")])
    left = {r.doc_id: r for r in passages.without_repeats(docs).collect()}
    assert set(left) == {1, 3, 4}
    assert left[1].text == text and left[3].text == "one two end" and left[3].n_chars == 11
    assert left[4].text == "kept  as\nit is"


def test_an_empty_table(make_docs):
    assert found(make_docs([])) == []


def test_a_cover_must_be_complete(make_docs):
    with pytest.raises(ValueError):
        passages.repeated_passages(make_docs([]), period=7, cover=(0, 1, 2))


def test_the_sql_agrees(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = con.execute(passages.SQL)
    names = [c[0] for c in want.description]
    got = passages.op9_passages(spark, small).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
