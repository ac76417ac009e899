"""Toxicity as a distance-weighted vote of the nearest labelled texts by TF-IDF cosine.

Terms are the lower-cased runs of letters and digits, all those of the examples. A
text's vector holds (1 + ln tf) * idf * gain of these terms, scaled to length one, with idf from
all documents. The gain is the root of G2, the log-likelihood ratio of the 2 x 2 table of documents,
for a term whose presence depends on the label, either way, and one for every other term: no word is left out, but those that tell weigh more. The nearest
``neighbours`` examples are found exactly: the examples' vectors lie in an inverted index cut into
blocks of example numbers; each term knows its largest weight in each block, so the sum over a
text's terms bounds every cosine in a block. Terms that a twentieth of the examples hold lie in
nearly every block and bound nothing; their weights are dense rows instead, and one product for a group of
texts gives their exact part of every cosine. Blocks are taken by falling bound, that part and the
block maxima of all other terms, until the bound is below the least cosine that still counts.

The score is the weighted share of toxic neighbours, each weighted by its cosine and smoothed
towards the rate among all examples. A text that shares no term with any example has no neighbour
and gets the smoothed rate of the examples without a term that speaks for the label. Evidence: the
ids of the nearest examples with their cosines.

Bounds, all parameters: ``max_examples`` labelled rows give the gains, the first ``max_indexed`` of
them the index (drawn by one seeded hash). Corpus statistics cover all documents.

Nulls and ties: a null or empty text has no terms; labels that are null are not used; an id
labelled more than once counts as toxic if half of its labels say so; of an example's rows that
share an id the least text counts; neighbours of equal cosine are taken by the smaller id. Repeated
rows get equal scores. A very long text counts whole, by its distinct terms. An empty table has no
scores; without labels the score is the rate of none, 0. Columns other than the id and the text
are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import documents, run_starts, store, text_blocks

MAX_EXAMPLES = 20_000
MAX_INDEXED = 4_000
NEIGHBOURS = 15
#: G2 of one degree of freedom; chance reaches it once in 130,000 terms.
LEAST_G2 = 20.0
#: Documents that hold a term at least.
LEAST_DOCUMENTS = 5
#: Weight of the overall rate beside the neighbours' cosines.
SMOOTHING = 0.5
BLOCK = 64
#: Blocks looked at before the first comparison with their bounds.
FIRST_BLOCKS = 4
#: Share of the examples that hold a term whose weights are a dense row.
DENSE_SHARE = 0.05
#: Texts whose dense parts are one product.
GROUP = 64
FOLDS = 5
SEED = 42
_TERM = re.compile(r"\w+")


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text is divisible by FOLDS; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, most: int) -> list[tuple[int, int]]:
    """At most ``most`` ids outside the held-out fold with their labels, in the order of a hash."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(~held_out(id_col)).groupBy(F.col(id_col).cast("bigint").alias("id")).agg(
        (F.avg(label_col) >= 0.5).cast("int").alias("label")
    )
    rows = known.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(most).collect()
    return [(r.id, r.label) for r in rows]


def _words(text: str | None) -> Counter:
    return Counter(_TERM.findall(text.lower())) if text else Counter()


def _label_counts(batches):
    """Clean, toxic and indexed examples of this partition that hold each word."""
    counts = Counter(), Counter(), Counter()
    seen = [0, 0, 0]
    for block in text_blocks(batches, "text"):
        for label, indexed, text in zip(block["label"], block["indexed"], block["text"], strict=True):
            words = _words(text).keys()
            for side in (label, 2) if indexed else (label,):
                counts[side].update(words)
                seen[side] += 1
    names = list(counts[0].keys() | counts[1].keys())
    # A row without a term carries the numbers of documents.
    yield pa.RecordBatch.from_arrays(
        [pa.array([*names, None], pa.string()),
         *(pa.array([*(c[t] for t in names), n], pa.int64()) for c, n in zip(counts, seen, strict=True))],
        ["term", "clean", "toxic", "indexed"],
    )


def _g2(a: Column, b: Column, n0: int, n1: int) -> Column:
    """Log-likelihood ratio of term presence (a of n0 clean, b of n1 toxic) and label."""
    n = n0 + n1
    cells = [(a, n0, a + b), (b, n1, a + b), (n0 - a, n0, n - a - b), (n1 - b, n1, n - a - b)]
    parts = [
        F.when(o > 0, o * F.ln(o * F.lit(float(n)) / (F.lit(float(rows)) * columns)))
        .otherwise(0.0) for o, rows, columns in cells
    ]
    return 2 * (parts[0] + parts[1] + parts[2] + parts[3])


def example_terms(examples: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Every term that an indexed example holds, and its gain, below zero if it speaks for clean texts.

    ``examples``: id, label, indexed, text.
    """
    counted = examples.mapInArrow(
        _label_counts, "term string, clean bigint, toxic bigint, indexed bigint"
    )
    sums = store(
        counted.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "indexed"))), "terms"
    )
    total = sums.where(F.col("term").isNull()).first()
    if total is None:
        return pa.array([], pa.string()), np.zeros(0)
    a, b = F.col("clean").cast("double"), F.col("toxic").cast("double")
    g2 = _g2(a, b, total.clean, total.toxic) if total.clean and total.toxic else F.lit(0.0)
    tells = (a + b >= LEAST_DOCUMENTS) & (g2 >= LEAST_G2)
    side = F.when(b * total.clean > a * total.toxic, 1.0).otherwise(-1.0)
    rows = sums.where(F.col("term").isNotNull() & (F.col("indexed") > 0)).select(
        "term", F.when(tells, side * F.sqrt(g2)).otherwise(1.0).alias("gain")
    )
    found = rows.orderBy("term").toArrow()
    return found["term"].combine_chunks(), _numbers(found["gain"])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A column without nulls as one array that owns its values."""
    return np.array(column.to_numpy())


def _term_vectors(batches, terms):
    number = {term: n for n, term in enumerate(terms.value.to_pylist())}
    for block in text_blocks(batches, "text"):
        numbers, counts, ends = [], [], [0]
        for text in block["text"]:
            words = _words(text)
            held = {number[word]: n for word, n in words.items() if word in number}
            numbers.extend(held.keys())
            counts.extend(held.values())
            ends.append(len(numbers))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(block["id"], pa.int64()),
             pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))],
            ["id", "terms", "counts"],
        )


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all half-open ranges in a row, and the range that each comes from."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return np.arange(len(of)) + (starts - before)[of], of


@dataclass
class BlockIndex:
    """Unit vectors of the examples as postings by term, cut into blocks of example numbers.

    A cell is a term in a block; cells are in the order of terms and blocks, and the postings in
    the order of their cells.
    """

    ids: np.ndarray
    labels: np.ndarray
    scale: np.ndarray      # idf and gain, per term
    cells: np.ndarray      # per term: its first cell
    block: np.ndarray      # per cell
    largest: np.ndarray    # per cell: the block maximum
    first: np.ndarray      # per cell: where its postings start
    example: np.ndarray
    weight: np.ndarray
    row: np.ndarray        # per term: its dense row, or -1
    dense: np.ndarray      # weights by dense row and example, blocks filled up
    blank: float           # score of a text without a neighbour: that of unmarked examples
    rate: float

    def dense_parts(self, texts) -> np.ndarray:
        """The dense terms' part of every cosine, by text and example."""
        of_terms = np.zeros((len(texts), len(self.dense)))
        for n, (terms, counts) in enumerate(texts):
            row = self.row[terms]
            of_terms[n, row[row >= 0]] = _unit(terms, counts, self.scale)[row >= 0]
        return of_terms @ self.dense

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, part: np.ndarray | None = None):
        """Numbers and cosines of the k nearest examples with a positive cosine, exactly."""
        if part is None:
            part = self.dense_parts([(terms, counts)])[0]
        sparse = self.row[terms] < 0
        weights, terms = _unit(terms, counts, self.scale)[sparse], terms[sparse]
        cells, of = _ranges(self.cells[terms], self.cells[terms + 1])
        block, weights = self.block[cells], weights[of]
        blocks = len(part) // BLOCK
        bound = part.reshape(blocks, BLOCK).max(axis=1)
        bound = bound + np.bincount(block, weights * self.largest[cells], minlength=blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best_n, best_c = np.zeros(0, dtype=np.int64), np.zeros(0)
        step = FIRST_BLOCKS
        while len(order):
            now = np.zeros(blocks, dtype=bool)
            now[order[:step]] = True
            taken = now[block]
            chosen = cells[taken]
            at, cell = _ranges(self.first[chosen], self.first[chosen + 1])
            cosine = part + np.bincount(
                self.example[at], weights[taken][cell] * self.weight[at], minlength=len(part)
            )
            least = best_c[-1] - 1e-11 if len(best_c) >= k else 0.0
            some = np.flatnonzero(cosine > least)
            some = some[now[some // BLOCK]]
            numbers = np.concatenate([best_n, some])
            cosines = np.concatenate([best_c, cosine[some]])
            if len(cosines) > k:
                near = cosines >= np.partition(cosines, -k)[-k] - 1e-11
                numbers, cosines = numbers[near], cosines[near]
            first = np.lexsort((self.ids[numbers], -np.round(cosines, 12)))[:k]
            best_n, best_c = numbers[first], cosines[first]
            order, step = order[step:], blocks
            if len(best_c) >= k:
                order = order[bound[order] >= best_c[-1] - 1e-11]
        return best_n, best_c

    def score(self, terms: np.ndarray, counts: np.ndarray, k: int, part: np.ndarray | None = None):
        numbers, cosines = self.nearest(terms, counts, k, part)
        if not len(numbers):
            return self.blank, self.ids[numbers], cosines
        votes = (cosines * self.labels[numbers]).sum() + SMOOTHING * self.rate
        return float(votes / (cosines.sum() + SMOOTHING)), self.ids[numbers], cosines

    def scores(self, texts, k: int) -> list:
        found = []
        for start in range(0, len(texts), GROUP):
            some = texts[start:start + GROUP]
            parts = self.dense_parts(some)
            found.extend(self.score(*text, k, part) for text, part in zip(some, parts, strict=True))
        return found


def _unit(terms: np.ndarray, counts: np.ndarray, scale: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * scale[terms]
    length = np.sqrt((weights * weights).sum())
    return weights / length if length else weights


def build_index(examples, scale: np.ndarray, marks: np.ndarray) -> BlockIndex:
    """``examples``: (id, label, term numbers, counts) of every indexed row.

    ``marks``: whether a term speaks for the label.
    """
    blank = [label for _, label, terms, _ in examples if not marks[np.asarray(terms, dtype=np.int64)].any()]
    rate = sum(label for _, label, *_ in examples) / len(examples) if examples else 0.0
    rows = [(i, label, np.asarray(terms, dtype=np.int32), np.asarray(counts))
            for i, label, terms, counts in examples if len(terms)]
    # Examples with the same leading term share a block, which keeps the block maxima apart.
    vectors = [_unit(terms, counts, scale) for *_, terms, counts in rows]
    lead = [(terms[v == v.max()].min(), label) for (_, label, terms, _), v in zip(rows, vectors, strict=True)]
    order = sorted(range(len(rows)), key=lambda n: (*lead[n], rows[n][0]))
    joined = lambda parts, kind: np.concatenate([np.zeros(0, dtype=kind), *parts])
    term = joined([rows[n][2] for n in order], np.int32)
    example = np.repeat(np.arange(len(order), dtype=np.int32), [len(rows[n][2]) for n in order])
    weight = joined([vectors[n] for n in order], float)
    del vectors
    # Examples come in order already, so a stable sort by term is one by both.
    sort = np.argsort(term, kind="stable")
    term, example, weight = term[sort], example[sort], weight[sort]
    del sort
    common = np.flatnonzero(np.bincount(term, minlength=len(scale)) >= max(1, DENSE_SHARE * len(rows)))
    row = np.full(len(scale), -1)
    row[common] = np.arange(len(common))
    dense = np.zeros((len(common), -(-len(rows) // BLOCK) * BLOCK))
    often = row[term] >= 0
    dense[row[term[often]], example[often]] = weight[often]
    term, example, weight = term[~often], example[~often], weight[~often]
    first = run_starts(term, example // BLOCK)
    return BlockIndex(
        np.array([rows[n][0] for n in order], dtype=np.int64),
        np.array([rows[n][1] for n in order], dtype=float), scale,
        np.searchsorted(term[first], np.arange(len(scale) + 1)), example[first] // BLOCK,
        np.maximum.reduceat(weight, first) if len(first) else weight,
        np.append(first, len(term)), example, weight, row, dense,
        (sum(blank) + SMOOTHING * rate) / (len(blank) + SMOOTHING), rate,
    )


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _chunked_lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [own for chunk in column.chunks for own in _lists(chunk)]


def _scores(batches, index, k: int):
    for batch in batches:
        at: dict[bytes, int] = {}
        texts, place = [], []
        for terms, counts in zip(_lists(batch.column("terms")), _lists(batch.column("counts")), strict=True):
            # Equal texts are scored once.
            key = hashlib.blake2b(terms.tobytes() + counts.tobytes(), digest_size=16).digest()
            if key not in at:
                at[key] = len(texts)
                texts.append((terms, counts))
            place.append(at[key])
        found = index.value.scores(texts, k)
        out = [found[n] for n in place]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([s for s, *_ in out], pa.float64()),
             pa.array([n for _, n, _ in out], pa.list_(pa.int64())),
             pa.array([c for *_, c in out], pa.list_(pa.float64()))],
            ["id", "score", "neighbours", "cosines"],
        )


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", neighbours: int = NEIGHBOURS, max_examples: int = MAX_EXAMPLES,
    max_indexed: int = MAX_INDEXED, learn_from: DataFrame | None = None,
) -> DataFrame:
    """id, score, neighbours (ids of examples) and cosines of every row of ``docs``.

    ``learn_from`` holds the labelled documents, by default ``docs`` itself; the documents that
    are scored give the corpus statistics.
    """
    spark = docs.sparkSession
    rows = lambda df: df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sample = labelled_sample(labels, id_col, label_col, max_examples)
    wanted = spark.createDataFrame(
        [(i, label, n < max_indexed) for n, (i, label) in enumerate(sample)],
        "id bigint, label int, indexed boolean",
    )
    known = rows(docs if learn_from is None else learn_from).join(F.broadcast(wanted), "id")
    examples = store(known.groupBy("id", "label", "indexed").agg(F.min("text").alias("text")), "examples")
    # What comes to the driver comes as Arrow columns, a few bytes a number instead of an object.
    names, gain = example_terms(examples)
    terms = spark.sparkContext.broadcast(names)

    def vectors(df):
        found = df.select("id", "text").mapInArrow(
            lambda batches: _term_vectors(batches, terms), "id bigint, terms array<int>, counts array<int>"
        )
        return store(found, "vectors")

    scored = vectors(rows(docs))
    total = scored.count()
    holds = scored.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    scale = np.full(len(gain), np.log(1 + total) + 1)
    scale[_numbers(holds["term"])] = np.log((1 + total) / (1 + _numbers(holds["count"]))) + 1
    scale *= np.abs(gain)
    learned = vectors(examples.where("indexed")).orderBy("id").toArrow().combine_chunks()
    terms.destroy()
    label_of = dict(sample)
    found = [
        (i, label_of[i], *lists) for i, *lists in zip(
            learned["id"].to_pylist(), *(_chunked_lists(learned[c]) for c in ("terms", "counts")), strict=True
        )
    ]
    index = spark.sparkContext.broadcast(build_index(found, scale, gain > 1))
    return scored.mapInArrow(
        lambda batches: _scores(batches, index, neighbours),
        "id bigint, score double, neighbours array<bigint>, cosines array<double>",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, known: DataFrame) -> DataFrame:
    """The documents that score below one half, all columns as they are.

    Rows without an id stay unless a row without an id and with the same text is toxic; to tell
    them apart their texts are scored by themselves.
    """
    own = "_" + "".join(docs.columns)
    keyed = docs.withColumn(own, F.xxhash64("doc_id", "text"))
    scores = toxicity_scores(
        keyed.select(F.col(own).alias("doc_id"), "text"), labels, learn_from=known
    )
    toxic = scores.where(F.col("score") >= 0.5).select(F.col("id").alias(own)).distinct()
    return keyed.join(toxic, own, "left_anti").drop(own)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    scores = toxicity_scores(documents(spark, folder), labels)
    return scores.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
