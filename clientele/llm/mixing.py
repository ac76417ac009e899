"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target is a multiple of its size, its rate. A document is taken floor(rate) times
surely and once more with the probability that remains. The cube method (Deville and Tillé 2004)
turns these probabilities into zeros and ones while it keeps two totals of each source: tokens
and documents. In the flight phase three documents at a time move along the direction in which
both totals stay as they are, until one of them reaches 0 or 1. Blocks of a source fly on their
own, which leaves two open documents a block at most; those fly again in fewer blocks, round by
round, until one block a source is left. The landing of its last two documents keeps the token
total as near as it can.

Blocks are cut by a seeded hash of the rows, so a large source is many blocks and reruns agree.

Nulls and ties: a null text has size 0; a null source is a source of its own, the last one.
Sources without words have target 0 and rate 0. Repeated rows and rows without an id are
documents of their own. Other columns stay as they are and may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.functions.ranks import with_position
from clientele.llm.common import NO_ID, WORD, documents, fresh, own_columns, store

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = 42
BLOCK_ROWS = 512

_STATE = (
    "key bigint, src bigint, source string, size bigint, source_size bigint, target double, "
    "rate double, n bigint, p double"
)
_EDGE = 1e-9


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, src, rows, source_size): src numbers the sources by code point, null last.

    No task holds all sources, however many there are.
    """
    sums = sized.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum("size").alias("source_size")
    )
    placed = with_position(sums, [F.col("source").isNull(), F.col("source")], "src")
    return placed.select("source", "src", "rows", "source_size")


def target_sizes(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``sources`` with target: ``share`` of all sizes by repeating weights, capped and reshared.

    Each round caps the sources above ``most`` times their size and shares what is left among
    the others by weight, until none is above. A round is one aggregate.
    """
    if share > most:
        raise ValueError("the sources cannot give the share asked for")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")
    )
    weighted = store(sources.withColumn("weight", weight), "weights")
    cap = F.col("source_size") * F.lit(most)
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = weighted.agg(
            F.count_if(full).alias("full"),
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row.full == capped or not row.open:
            break
        capped = row.full
        level = (share * total - most * row.used) / row.open
    return weighted.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _step(a: float, b: float, c: float) -> tuple[float, float, float]:
    """A direction in which three documents of these sizes keep both totals."""
    u = (b - c, c - a, a - b)
    return u if any(u) else (1.0, -1.0, 0.0)


def _move(p: list[float], u, at: list[int], chance: float) -> None:
    """Move the probabilities along u or against it to the side of the cube, as a fair game."""
    ahead = min(((1 - p[i]) / x if x > 0 else -p[i] / x) for i, x in zip(at, u) if x)
    back = min((p[i] / x if x > 0 else (p[i] - 1) / x) for i, x in zip(at, u) if x)
    step = ahead if chance * (ahead + back) < back else -back
    for i, x in zip(at, u):
        q = p[i] + step * x
        p[i] = 0.0 if q < _EDGE else 1.0 if q > 1 - _EDGE else q


def flight(sizes: list[float], p: list[float], draws) -> list[float]:
    """Probabilities after the flight: at most two are neither 0 nor 1, both totals as before."""
    p = list(p)
    open_ = []
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        open_.append(i)
        while len(open_) == 3:
            _move(p, _step(*(sizes[k] for k in open_)), open_, next(draws))
            open_ = [k for k in open_ if 0.0 < p[k] < 1.0]
    return p


def landing(sizes: list[float], p: list[float], draws) -> list[float]:
    """Zeros and ones for the open documents: first the tokens keep, then the nearer side."""
    p = list(p)
    open_ = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
    while len(open_) >= 2:
        i, j = open_[:2]
        a, b = sizes[i], sizes[j]
        u = (b, -a) if a and b else (0.0, 1.0) if a else (1.0, 0.0)
        _move(p, u, [i, j], next(draws))
        open_ = [k for k in open_ if 0.0 < p[k] < 1.0]
    for i in open_:
        p[i] = 1.0 if p[i] > 0.5 or (p[i] == 0.5 and next(draws) < 0.5) else 0.0
    return p


def _draws(seed: int):
    """Uniform numbers from a 64-bit mixing generator; the same for the same seed."""
    state = seed & (2**64 - 1)
    while True:
        state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        yield ((z ^ (z >> 31)) >> 11) / 2**53


def _fly(seed: int, last: bool):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["spread", "key", "size"], kind="stable")
        draws = _draws(seed + int(rows["src"].iloc[0]) * 1_000_003 + int(rows["block"].iloc[0]))
        sizes = rows["size"].astype(float).tolist()
        p = flight(sizes, rows["p"].tolist(), draws)
        if last:
            p = landing(sizes, p, draws)
        return rows.assign(p=p).drop(columns=["spread", "block"])

    return block


def balanced_copies(state: DataFrame, rows: int, seed: int = SEED) -> list[DataFrame]:
    """The rows of ``state`` with every p settled to 0 or 1.

    n is the bound of the open rows of the row's source and ``rows`` the largest n; they fix the
    blocks and the number of rounds. Each table of the result holds what one round settled.
    """
    is_open = (F.col("p") > 0) & (F.col("p") < 1)
    done, left, round_ = [state.where(~is_open)], state.where(is_open), 0
    while True:
        last = rows <= BLOCK_ROWS
        blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("bigint")
        dealt = left.withColumn("spread", F.xxhash64("key", F.lit(seed + round_)))
        dealt = dealt.withColumn("block", F.pmod("spread", blocks)).withColumn("n", 2 * blocks)
        flown = store(
            dealt.groupBy("src", "block").applyInPandas(_fly(seed + round_, last), _STATE),
            "flight",
        )
        done.append(flown.where(~is_open))
        if last:
            return done
        left, rows, round_ = flown.where(is_open), 2 * math.ceil(rows / BLOCK_ROWS), round_ + 1


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, size, source, source_size, target, rate, copies, taken."""
    sized = store(
        docs.select(
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("key"),
            F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        ),
        "sizes",
    )
    sources = store(target_sizes(source_sizes(sized), weights, share, most), "targets")
    most_rows = sources.agg(F.max("rows")).first()[0] or 0
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    rated = sources.select(
        F.col("source").alias("name"), "src", "source_size", "target", rate.alias("rate"),
        F.col("rows").alias("n"),
    )
    part = F.col("rate") - F.floor("rate")
    state = sized.join(rated, sized.source.eqNullSafe(rated.name)).select(
        "key", "src", "source", "size", "source_size", "target", "rate", "n",
        F.when(part > 1 - _EDGE, F.lit(0.0)).otherwise(part).alias("p"),
    )
    rows, *others = balanced_copies(state, most_rows, seed)
    for more in others:
        rows = rows.unionByName(more)
    copies = F.floor(F.col("rate") + F.lit(_EDGE)).cast("bigint") + F.col("p").cast("bigint")
    return rows.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("id"), "size", "source",
        "source_size", "target", "rate", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents as the mix takes them: a document taken twice is two rows, some are none.

    Rows that share id, size and source take their copies in turn, in the order of a hash of all
    their columns, so reruns agree.
    """
    own = fresh(docs)
    key = [own + name for name in ("id", "size", "source", "turn")]
    alike = Window.partitionBy(*key[:3])

    def keyed(ids: str, size, source: str):
        return [
            F.coalesce(F.col(ids).cast("bigint"), F.lit(NO_ID)).alias(key[0]), size.alias(key[1]),
            F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias(key[2]),
        ]

    copies = own + "copies"
    taken = mix(docs, **settings)
    chosen = taken.select(
        *keyed("id", F.col("size"), "source"), F.col("copies").alias(copies)
    ).withColumn(key[3], F.row_number().over(alike.orderBy(F.desc(copies))))
    rows = docs.select("*", *keyed("doc_id", word_count("text"), "source")).withColumn(
        key[3], F.row_number().over(alike.orderBy(F.xxhash64(*own_columns(docs))))
    )
    return (
        rows.join(chosen.where(F.col(copies) > 0), key)
        .withColumn(own + "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .select(*own_columns(docs))
    )


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(documents(spark, folder))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
        "source", "copies",
    )
