"""Token counts by byte-pair merging with a heap and a linked list, without making identifiers.

A normalised text starts as one symbol per character. The adjacent pair whose joined piece ranks
lowest, the leftmost of equals, is merged again and again: a heap holds the pairs that may merge,
a doubly linked list the symbols. The count is the initial symbols minus the merges; a character
outside the vocabulary that is never merged counts as its UTF-8 bytes (byte fallback).

No piece of such a vocabulary holds a space mark after another character, so merges never cross
from a word into the mark of the next one. Stretches from a mark to the next are therefore
counted on their own, and a stretch that comes again is looked up. A vocabulary with such a
piece is merged over the whole text at once.

Nulls: a null text has 0 bytes and 0 tokens, and so has an empty one. Texts are counted whole,
whatever their length. Repeated rows get equal counts; rows without an id are counted as well;
other columns are not read.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import documents, kept_in_worker, text_blocks

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Stretches whose counts a worker remembers; then it starts anew. Longer ones are not kept.
REMEMBERED = 400_000
LONGEST = 48
MARK = "▁"


class Merger:
    """Counts the symbols that remain of a string when its pairs are merged by rank."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks

    def count(self, text: str) -> int:
        symbols = list(text)
        n = len(symbols)
        ranks = self.ranks
        heap = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in ranks:
                heap.append((ranks[joined], i, joined))
        if not heap:
            return n + self._outside(symbols)
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            _, left, joined = heapq.heappop(heap)
            first = symbols[left]
            if first is None:
                continue
            right = after[left]
            # The pair may have changed since it was pushed.
            if right >= n or len(first) + len(symbols[right]) != len(joined) or (
                first + symbols[right] != joined
            ):
                continue
            merges += 1
            symbols[left], symbols[right] = joined, None
            next_ = after[right]
            after[left] = next_
            if next_ < n:
                before[next_] = left
                pair = joined + symbols[next_]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], left, pair))
            previous = before[left]
            if previous >= 0:
                pair = symbols[previous] + joined
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], previous, pair))
        return n - merges + self._outside(s for s in symbols if s is not None)

    def _outside(self, symbols) -> int:
        ranks = self.ranks
        return sum(len(s.encode()) - 1 for s in symbols if s not in ranks)


class _Remembered(dict):
    """Counts of the stretches that start with a mark, by what follows the mark."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger = merger

    def __missing__(self, rest: str) -> int:
        n = self.merger.count(MARK + rest)
        if len(rest) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[rest] = n
        return n


class PieceCounter:
    """Token counts of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        special = [i for i in ids if self.model.is_control(i) or self.model.is_unknown(i)]
        if any(self.model.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        own = [i for i in ids if i not in set(special) and not self.model.is_byte(i)]
        if len(own) + len(special) == len(ids):
            raise ValueError("the model needs byte fallback")
        ranks = {self.model.id_to_piece(i): -self.model.get_score(i) for i in own}
        self.merger = Merger(ranks)
        self.apart = not any(MARK in piece.lstrip(MARK) for piece in ranks)
        self.remembered = _Remembered(self.merger)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = self.model.normalize(text)
        if not self.apart:
            return self.merger.count(text)
        head, *rest = text.split(MARK)
        total = self.merger.count(head) if head else 0
        if "" not in rest:
            return total + sum(map(self.remembered.__getitem__, rest))
        marks = 0
        for i, word in enumerate(rest):
            # A run of marks belongs to the word after it; at the end it stands alone.
            if word or i == len(rest) - 1:
                total += self.remembered[MARK * marks + word]
                marks = 0
            else:
                marks += 1
        return total


def _path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


@kept_in_worker
def _counter() -> PieceCounter:
    return PieceCounter(_path())


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_bytes, n_tokens) of every row."""

    def each(batches):
        for block in text_blocks(batches, "text"):
            count = _counter().count
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["id"], pa.int64()),
                 pa.array([len(t.encode()) for t in block["text"]], pa.int64()),
                 pa.array([count(t) for t in block["text"]], pa.int64())],
                [id_col, "n_bytes", "n_tokens"],
            )

    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(each, f"`{id_col}` bigint, n_bytes bigint, n_tokens bigint")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(documents(spark, folder))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
