import random
import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clientele.llm import packing


EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def exact_ids(text):
    return [*EXACT.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, df, capacity=1024):
    got = packing.pack(df, capacity=capacity).collect()
    want = []
    for r in rows:
        ids = np.array(exact_ids(r[1]), dtype="<u4")
        for i, (s, n) in enumerate(packing.cut_points(len(ids), capacity)):
            want.append((str(r[0]), i, s, n, zlib.crc32(ids[s:s + n].tobytes())))
    found = [(str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(found) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in got)


def test_the_small_documents(small_rows, small_docs):
    n, tokens = check(small_rows, small_docs)
    assert n <= -(-tokens // 1024) + 1


def test_nulls_other_scripts_special_strings_and_repeats(make_docs):
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "日本語 ß é – … 🙂"), (4, "same"),
            (4, "same"), (None, "x" * 500), (None, "  \t tab"), (5, "word " * 3000)]
    check(rows, make_docs(rows), 64)


def test_an_empty_table(make_docs):
    assert packing.pack(make_docs([])).count() == 0


@pytest.mark.parametrize("length, want", [
    (5, [(0, 5)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)]),
])
def test_the_first_piece_is_the_rest(length, want):
    assert packing.cut_points(length, 8) == want


def least_sequences(sizes, capacity):
    """The fewest sequences, by trying every sequence for each piece in turn."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            k = rooms.index(room)
            place(i + 1, [*rooms[:k], room - sizes[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_fixed_sets_never_cost_a_sequence():
    rng = random.Random(1)
    for _ in range(250):
        capacity = rng.randint(6, 24)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        fixed, left = packing.reduce_by_dominance(counts, capacity)
        rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
        used = [s for pieces, n in fixed for s in pieces * n]
        assert sorted(used + rest) == sorted(sizes)
        assert all(sum(pieces) <= capacity for pieces, _ in fixed)
        assert sum(n for _, n in fixed) + least_sequences(rest, capacity) == least_sequences(sizes, capacity)


def slow_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - s)
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


def test_best_fit_by_counts_is_best_fit():
    rng = random.Random(2)
    for capacity, n in combinations_with_replacement([10, 40, 100], 2):
        sizes = [rng.randint(1, capacity) for _ in range(n * 3)]
        found = packing.best_fit({s: sizes.count(s) for s in sizes}, capacity)
        rooms = sorted(capacity - sum(c) for c, k in found for _ in range(k))
        assert rooms == slow_best_fit(sizes, capacity)
