import re

import duckdb

from clientele.llm import quality


def slow_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def columns(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)


def test_counts_of_the_small_documents(small_rows, spark, small):
    got = {r.doc_id: r for r in quality.op7_quality(spark, small).collect()}
    assert len(got) == len(small_rows)
    for i, text, *_ in small_rows:
        r = got[i]
        assert columns(r) == slow_counts(text)
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_the_sql_agrees(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = con.execute(quality.SQL).fetchall()
    got = [tuple(r) for r in quality.op7_quality(spark, small).collect()]
    assert sorted(got) == sorted(want)


def test_nulls_empty_texts_and_repeats(make_docs):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t\n ", "en", "a"),
            (4, words, None, "a"), (4, words, None, "a"), (None, words, "en", None),
            (5, "a b c d e f g h " * 3, "en", "a"), (6, "ß\nß\n \nß", "de", "b")]
    got = quality.quality_rules(make_docs(rows)).collect()
    assert sorted(map(columns, got)) == sorted(slow_counts(r[1]) for r in rows)
    assert sum(r.kept for r in got) == 3
    assert quality.quality_rules(make_docs([])).count() == 0


def test_limits_follow_the_group(make_docs):
    plain = [(i, " ".join(f"word{(i * 31 + k * 7) % 997}" for k in range(40)), "en", "a")
             for i in range(80)]
    marked = [(100 + i, " ".join(f"#word{(i * 17 + k * 5) % 991}" for k in range(40)), "en", "b")
              for i in range(80)]
    odd = [(200, marked[0][1].replace("word", "term"), "en", "a"), (201, plain[0][1], "en", "b")]
    kept = {r.doc_id for r in quality.quality_rules(make_docs(plain + marked + odd)).collect() if r.kept}
    assert kept == {r[0] for r in plain + marked} | {201}


def test_sources_with_other_symbol_habits_have_other_limits(spark, make_docs):
    """Symbols in a seventh of the texts: the quartiles are zero, the limits differ all the same."""
    def text(i, marks):
        words = [f"word{(i * 31 + k * 7) % 997}" for k in range(40)]
        return " ".join([*words[:40 - marks], *(f"#{w}" for w in words[40 - marks:])])

    rows = [(i, text(i, 8 if i % 7 == 0 else 0), "en", "code") for i in range(140)]
    rows += [(1000 + i, text(i, 0), "en", "news") for i in range(140)]
    rows += [(2000, text(3, 9), "en", "code"), (2001, text(3, 9), "en", "news")]
    docs = make_docs(rows)
    counts = quality.base_counts(docs, "doc_id", "text", "lang", "source")
    limits = {r.source: r.most_symbols for r in quality.adaptive_limits(counts).collect()}
    assert limits == {"code": 700, "news": 100}
    kept = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    assert kept == {r[0] for r in rows} - {2001}


def test_sketches_round_to_seven_bits(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 5000, 3).select("id", quality._rounded(F.col("id")).alias("v")).collect()
    assert all(r.v <= r.id and (r.id < 128 or (r.id - r.v) * 64 < r.id) for r in rows)
    assert len({r.v for r in rows}) < 500
