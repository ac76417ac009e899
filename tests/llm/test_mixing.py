import random

from clientele.llm import mixing


def targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """Sizes by source in order; share by weight, cap, share what is left again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        level = rest / open_ if open_ else 0.0
        more = {s for s in names if s not in full and weight[s] * level > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= more


def check(rows, df):
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = targets(sizes)
    assert sorted((str(r.id), r.size) for r in got) == sorted((str(r[0]), size(r[1])) for r in rows)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 for r in own)
        assert all(0 <= r.copies <= 2 and r.taken == r.copies * r.size for r in own)
        off = abs(sum(r.taken for r in own) - want[s])
        assert off <= max(r.size for r in own) / 2 + 1e-6
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert abs(sum(r.copies for r in own) - rate * len(own)) <= 3
    return got


def test_the_small_documents(small_rows, small_docs):
    first = check(small_rows, small_docs)
    again = mixing.mix(small_docs.repartition(7)).collect()
    key = lambda r: (r.id, r.copies)
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_many_blocks_and_rounds(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 8)
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    check(rows, make_docs(rows))


def test_nulls_empty_texts_and_repeated_rows(make_docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (None, "x y", "en", None),
            (None, "x y", "en", None), (3, "a b c", "en", "ö"), (3, "a b c", "en", "ö"),
            (4, "one", "en", "b"), (5, " \n", "en", "z")]
    check(rows, make_docs(rows))


def test_an_empty_table(make_docs):
    assert mixing.mix(make_docs([])).count() == 0


def test_documents_come_as_often_as_taken(make_docs):
    rows = [(i % 40, "w " * (i % 9), "en", f"s{i % 3}") for i in range(80)]
    rows += [(None, "a b", "en", "s1")] * 3
    docs = make_docs(rows)
    taken = mixing.mix(docs).collect()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = sorted(str((r.id, r.size)) for r in taken for _ in range(r.copies))
    assert sorted(str((r.doc_id, len(r.text.split()))) for r in mixed.collect()) == want
