import re

from pyspark.sql import functions as F

from clientele.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    rows = language.fuse_languages(
        language.document_evidence(docs.where(held)), docs.where(~held).select("lang", "text")
    )
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = [(truth[r.number], r.lang) for r in rows.collect()]
    assert len(got) > 100 and sum(a == b for a, b in got) >= 0.97 * len(got)


def test_every_page_and_document_is_returned(spark):
    rows = language.op3_language(spark, FOLDER).collect()
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert sorted(r.page_id for r in rows if r.page_id is not None) == sorted(p.page_id for p in pages)
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(d.doc_id for d in docs)
    assert all(0 < r.score <= 1 + 1e-9 for r in rows)
    declared = {p.page_id: re.search(r'<html lang="(\w+)"', p.html)[1] for p in pages}
    same = [declared[r.page_id] == r.lang for r in rows if r.page_id is not None]
    assert sum(same) >= 0.97 * len(same)


EVIDENCE = "number bigint, kind string, host string, suffix string, declared string, text string"


def test_fusing_by_brute_force(spark):
    labelled = [("en", "the cat and the dog ran"), ("de", "der hund und die katze lief"),
                ("en", "this is that thing"), (None, "nobody knows"), ("de", None)]
    rows = [(i, "x", ["a.com", "b.com", "c.de", None][i % 4], ["com", "com", "de", None][i % 4],
             ["en", None, "de", "xx"][(i // 3) % 4], ["the dog", "die katze", "", None, "zzz"][i % 5])
            for i in range(40)]
    known = spark.createDataFrame(labelled, "lang string, text string")
    got = {r.number: r for r in language.fuse_languages(
        spark.createDataFrame(rows, EVIDENCE), known).collect()}
    langs, table = language.trigram_model(known)
    assert langs == ["de", "en"]
    import numpy as np

    p = {}
    for i, *_, text in rows:
        grams = language._trigrams(text or "")
        ll = table[grams].sum(axis=0) * 60 / (len(grams) + 60)
        p[i] = np.exp(ll - ll.max()) / np.exp(ll - ll.max()).sum()
    for i, _, host, suffix, said, _ in rows:
        others = [r for r in rows if r[0] != i]
        total = lambda pick: sum((p[r[0]] for r in others if pick(r)), np.zeros(2))
        share = sum(p.values()) / sum(map(sum, p.values()))
        s = total(lambda r: r[3] == suffix)
        prior = (s + 5 * share) / (s.sum() + 5)
        if host is not None:
            h = total(lambda r: r[2] == host and r[3] == suffix)
            prior = (h + 5 * prior) / (h.sum() + 5)
        post = p[i] * prior
        if said is not None:
            d, every = total(lambda r: r[4] == said), total(lambda r: r[4] is not None)
            rate = (d.sum() + 1) / (every.sum() + 1)
            post = post * (d + 5 * rate) / (every + 5)
        best = int(np.argmax(post))
        assert got[i].lang == langs[best]
        assert abs(got[i].score - post[best] / post.sum()) < 1e-9


def test_empty_tables_and_missing_labels(spark, make_docs):
    docs = make_docs([(1, "a text", None, "a"), (None, None, None, None), (1, "a text", None, "a")])
    rows = language.fuse_languages(language.document_evidence(docs), docs.select("lang", "text"))
    assert [r.lang for r in rows.collect()] == [None] * 3
    none = make_docs([])
    labelled = make_docs([(1, "some words here", "en")]).select("lang", "text")
    assert language.fuse_languages(language.document_evidence(none), labelled).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "not a url", "<html lang=EN-us>hi"),
                                   (None, "http://x.org/", "")], "page_id bigint, url string, html string")
    seen = {r.number: r for r in language.page_evidence(pages).collect()}
    assert seen[2].declared == "en" and seen[1].host is None and seen[None].suffix == "org"
    assert language.fuse_languages(language.page_evidence(pages), labelled).count() == 3


def test_more_languages_than_one_block_or_task_holds(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    words = {f"l{i:03}": ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(4)]
             for i in range(90)}
    labelled = spark.createDataFrame(
        [(lang, " ".join(own * 5)) for lang, own in words.items() for _ in range(3)],
        "lang string, text string").repartition(2)
    rows = spark.createDataFrame(
        [(i, "x", None, None, None, " ".join(own * 3)) for i, own in enumerate(words.values())],
        EVIDENCE)
    want = dict(enumerate(words))

    def found():
        return {r.number: (r.lang, r.text_lang, round(r.score, 9))
                for r in language.fuse_languages(rows, labelled).collect()}

    whole = found()
    assert {i: r[0] for i, r in whole.items()} == want
    monkeypatch.setattr(language, "BLOCK_LANGUAGES", 32)
    assert found() == whole
