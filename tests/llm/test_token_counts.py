import random

import public_tokenizers
import pytest
import sentencepiece

from clientele.llm import token_counts


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check(rows, df, library):
    got = token_counts.token_counts(df).collect()
    want = [(str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted(want)


def test_the_small_documents(small_rows, small_docs, library):
    check(small_rows, small_docs, library)


def test_odd_texts(make_docs, library):
    rng = random.Random(1)
    signs = ["a", "b", "the", " ", "  ", "\t", "\n", "ß", "日", "本", "🙂", "▁", "<s>", "</s>",
             "<unk>", "<0x41>", "é", " ", "0", "9", ".", "##", "\x01"]
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(1, 60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, " "), (None, "   "), (503, "x" * 3000),
             (504, "ab" * 2000), (504, "ab" * 2000), (505, "日本" * 500)]
    check(rows, make_docs(rows), library)


def test_an_empty_table(make_docs):
    assert token_counts.token_counts(make_docs([])).count() == 0


def test_merging_with_a_small_vocabulary():
    ranks = {c: 9 for c in "abc"} | {"ab": 1.0, "bc": 0.0, "abc": 2.0, "aa": 3.0}
    count = token_counts.Merger(ranks).count
    # The lowest rank goes first: a + bc, then abc.
    assert count("abc") == 1
    assert count("aab") == 2
    assert count("abab") == 2
    assert count("aaa") == 2
    assert count("aéa") == 4
    assert count("") == 0
