"""Exact quantiles that stay distributed.

The built-in ``percentile`` keeps every distinct value in one task. Here a first scan makes the
mergeable rank sketches of ``percentile_approx``, which bracket each wanted rank. A second one
counts the rows below the bracket, which prove that it holds the rank. A third one counts those
inside it, the only rows that leave the scan, in bins, most often one value each. Doubles are
mapped to 64-bit integers that order alike; where a bin holds several values around a rank, it
becomes the next interval, tightened to its own minimum and maximum, and one more scan divides it
by ``BINS``. A rank whose bracket fails the proof is searched for from the whole range, which six
scans end whatever the skew, with infinite values too. A scan returns at most ``BINS`` rows per
open interval; ties end a search at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of an interval: a power of two.
BITS = 12
BINS = 1 << BITS
#: Error of the sketches, as a share of the rows, and the distance of a bracket's ends.
ACCURACY = 10_000
BRACKET = 1e-3
_LEAST, _GREATEST = -(2**63), 2**63 - 1
_SIGN = np.int64(0x7FFFFFFFFFFFFFFF)


def ordered_integers(values: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles; both zeros are one, NaN comes last."""
    bits = (np.where(np.isnan(values), np.nan, values) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _SIGN, bits)


def _double(image: int) -> float:
    bits = np.array([image], dtype=np.int64)
    return float(np.where(bits < 0, bits ^ _SIGN, bits).view(np.float64)[0])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, nulls left out.

    ``df`` is scanned several times, so it should be a stored table.
    """
    columns = list(columns)
    ends = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-BRACKET, BRACKET)]
    sketched = df.agg(*[
        F.struct(
            F.count(c).alias("n"),
            F.percentile_approx(F.col(c).cast("double"), ends, ACCURACY).alias("ends"),
        ).alias(f"c{i}") for i, c in enumerate(columns)
    ]).first()
    sizes = {c: sketched[i].n for i, c in enumerate(columns)}
    places = {c: [(sizes[c] - 1) * p for p in probs] for c in columns}
    ranks = {
        c: sorted({r for h in places[c] for r in (math.floor(h), math.ceil(h))})
        for c in columns if sizes[c]
    }
    brackets = []
    for i, c in enumerate(columns):
        for j, h in enumerate(places[c] if sizes[c] else ()):
            lo, hi = ordered_integers(np.array(sketched[i].ends[2 * j:2 * j + 2])).tolist()
            brackets.append((c, lo, hi, {math.floor(h), math.ceil(h)}))
    found = _values_in_brackets(df, brackets)
    missing = {c: [r for r in own if r not in found.get(c, {})] for c, own in ranks.items()}
    missing = {c: own for c, own in missing.items() if own}
    if missing:
        first = _count_bins(df, [(c, _LEAST, _GREATEST) for c in missing])
        for c, values in _close_in(df, [(c, 0, own) for c, own in missing.items()], first).items():
            found.setdefault(c, {}).update(values)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        if c not in ranks:
            result[c] = [None] * len(probs)
            continue
        values = found[c]
        result[c] = [_between(values[math.floor(h)], values[math.ceil(h)], h % 1) for h in places[c]]
    return result


def _between(low: float, high: float, share: float) -> float:
    if low == high or not share:
        return low
    return low + (high - low) * share


def _values_in_brackets(df, brackets) -> dict[str, dict[int, float]]:
    """Values at the ranks that the counted brackets prove to hold."""
    if not brackets:
        return {}
    under = df.agg(*[
        F.count_if(F.col(c).cast("double") < F.lit(_double(lo))).alias(f"b{slot}")
        for slot, (c, lo, _, _) in enumerate(brackets)
    ]).first()
    bins = _count_bins(df, [(c, lo, hi) for c, lo, hi, _ in brackets])
    open_ = []
    for slot, (c, _, _, wanted) in enumerate(brackets):
        rows = sum(n for _, n, _, _ in bins.get(slot, []))
        held = [r for r in wanted if under[slot] <= r < under[slot] + rows]
        open_.append((c, under[slot], sorted(held)))
    return _close_in(df, open_, bins)


def _close_in(df, open_, bins) -> dict[str, dict[int, float]]:
    """Values at ranks from intervals (column, rows below, ranks) and their counted bins."""
    found: dict[str, dict[int, float]] = {c: {} for c, _, _ in open_}
    while open_:
        following = []
        for slot, (c, below, wanted) in enumerate(open_):
            pending = list(wanted)
            for _, n, lo, hi in sorted(bins.get(slot, [])):
                inside = [r for r in pending if r < below + n]
                pending = pending[len(inside):]
                searched = []
                for r in inside:
                    if lo == hi or r == below:
                        found[c][r] = _double(lo)
                    elif r == below + n - 1:
                        found[c][r] = _double(hi)
                    else:
                        searched.append(r)
                if searched:
                    following.append((c, lo, hi, below, searched))
                below += n
        open_ = [(c, below, wanted) for c, _, _, below, wanted in following]
        bins = _count_bins(df, [(c, lo, hi) for c, lo, hi, _, _ in following]) if open_ else {}
    return found


def _within(value: Column, lo: int, hi: int) -> Column:
    """Whether a double may lie in an interval of integers; only ends that are numbers cut."""
    low, high = _double(lo), _double(hi)
    inside = value.isNotNull()
    if not math.isnan(low):
        inside &= value >= F.lit(low)
    if not math.isnan(high):
        inside &= value <= F.lit(high)
    return inside


def _count_bins(df, intervals) -> dict[int, list[tuple]]:
    """For each interval (column, least, largest integer) its bins: number, rows, least, largest.

    Only rows that lie in some interval leave the scan.
    """
    names = sorted({c for c, _, _ in intervals})
    place = {c: f"c{i}" for i, c in enumerate(names)}
    plan = [
        (place[c], lo, hi, max(0, min((hi - lo).bit_length() - BITS, 63)))
        for c, lo, hi in intervals
    ]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[np.ndarray]] = [[] for _ in range(5)]
            images = {}
            for slot, (name, lo, hi, shift) in enumerate(plan):
                if name not in images:
                    values = batch.column(name).drop_null().to_numpy()
                    images[name] = np.sort(ordered_integers(values))
                held = images[name]
                held = held[np.searchsorted(held, lo):np.searchsorted(held, hi, side="right")]
                # The distance from the least one fits an unsigned number.
                number = (held.view(np.uint64) - np.uint64(lo % 2**64)) >> np.uint64(shift)
                starts = np.flatnonzero(np.diff(number, prepend=number[:1] + np.uint64(1)))
                ends = np.append(starts[1:], len(held))[: len(starts)]
                for part, values in zip(rows, (
                    np.full(len(starts), slot), number[starts].astype(np.int64), ends - starts,
                    held[starts], held[ends - 1],
                )):
                    part.append(values.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(part)) for part in rows], ["slot", "bin", "n", "lo", "hi"]
            )

    counted = (
        df.select(*[F.col(c).cast("double").alias(place[c]) for c in names])
        .where(reduce(Column.__or__, [_within(F.col(n), lo, hi) for n, lo, hi, _ in plan]))
        .mapInArrow(count, "slot bigint, bin bigint, n bigint, lo bigint, hi bigint")
        .groupBy("slot", "bin")
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    bins: dict[int, list[tuple]] = {}
    for r in counted.collect():
        bins.setdefault(r.slot, []).append((r.bin, r.n, r.lo, r.hi))
    return bins
