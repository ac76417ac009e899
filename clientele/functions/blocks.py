"""Work on two sets of rows that share a key, in blocks of bounded size.

Where every row of a key on one side has to meet every row of that key on the other, a frequent
key must not end up whole in one task. Both sides are cut into blocks by a hash of the row id, a
row is sent to each block it has to meet, and one task sees one block of either side. The work
function returns sums or minima per row, so pairs exist only as array cells inside a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.storage import materialize

LEFT_ROWS = 2_000
RIGHT_ROWS = 20_000
FEWEST_ROWS = 100
#: Distances computed at a time: they and their parts fit into a core's cache.
TILE_CELLS = 1 << 16
MOST_PARTITIONS = 4_000
#: Rows and columns of a tile of products: a quarter of a megabyte to half of one.
PLANE_ROWS = 256
#: Share of the norms below which a square of products has lost digits and is taken anew.
NEAR = 1e-5


def touch_buffers() -> None:
    """Let the library of products touch the memory that it copies operands to.

    It reads ahead there, and in a process where a page of it was never touched, each product of a
    small tile takes up to three times as long. One wide product, of a millisecond, is enough.
    """
    np.matmul(np.ones((PLANE_ROWS, 32)), np.ones((32, 2 * PLANE_ROWS)))


def block_count(rows: Column, size: int) -> Column:
    return F.greatest(F.ceil(rows / F.lit(size)), F.lit(1)).cast("int")


def meet_in_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    id_col: str,
    work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    left_rows: int = LEFT_ROWS,
    right_rows: int = RIGHT_ROWS,
) -> DataFrame:
    """``work(left block, right block)`` for all blocks of each key that both sides hold.

    Without keys every left row meets every right row.
    """
    keys = list(keys)
    # Both sides often come from one table; own column identities keep them apart.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    if keys:
        # Stored, so that its true size decides how it is joined; a frequent key then costs at
        # most a split join.
        lefts = left.groupBy(*keys).agg(block_count(F.count("*"), left_rows).alias("_lefts"))
        rights = right.groupBy(*keys).agg(block_count(F.count("*"), right_rows).alias("_rights"))
        sizes = materialize(lefts.join(rights, keys), "sizes")

        def sized(side: DataFrame) -> DataFrame:
            return side.join(sizes, keys)
    else:
        # A small left side is cut finer, so that every core has a block.
        rows = left.count()
        cores = left.sparkSession.sparkContext.defaultParallelism
        left_rows = max(FEWEST_ROWS, min(left_rows, -(-rows // cores)))
        sides = max(1, -(-rows // left_rows)), max(1, -(-right.count() // right_rows))
        counts = {
            "_lefts": F.lit(sides[0]), "_rights": F.lit(sides[1]),
        }

        def sized(side: DataFrame) -> DataFrame:
            return side.withColumns(counts)

    def spread(side: DataFrame, own: str, other: str):
        dealt = (
            sized(side)
            .withColumn(own, F.pmod(F.xxhash64(id_col), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .drop("_lefts", "_rights")
        )
        if not keys:
            # Blocks are few and heavy: a number of partitions of their own keeps small ones,
            # as they look to adaptive execution, from being merged into one task.
            dealt = dealt.repartition(min(2 * sides[0] * sides[1], MOST_PARTITIONS), "_left", "_right")
        return dealt.groupBy(*keys, "_left", "_right")

    blocks = spread(left, "_left", "_right").cogroup(spread(right, "_right", "_left"))
    return blocks.applyInPandas(lambda one, other: work(one, other), schema)


def distance_tiles(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Euclidean distances of a few left rows at a time to all right rows."""
    step = max(1, TILE_CELLS // max(len(right), 1))
    for start in range(0, len(left), step):
        rows = slice(start, start + step)
        squares = np.zeros((len(left[rows]), len(right)))
        for j in range(left.shape[1]):
            gap = left[rows, j, None] - right[None, :, j]
            squares += gap * gap
        yield rows, np.sqrt(squares)


def _direct_squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    squares = np.zeros((len(left), len(right)))
    for j in range(left.shape[1]):
        gap = left[:, j, None] - right[None, :, j]
        squares += gap * gap
    return squares


def within_tiles(
    left: np.ndarray, right: np.ndarray, radius: float
) -> Iterator[tuple[slice, np.ndarray]]:
    """Which right rows ``distance_tiles`` has within the radius of a few left rows at a time.

    Squares come from products; those too near the radius for their rounding, and all where
    numbers are not finite, are taken from differences.
    """
    touch_buffers()
    width = left.shape[1]
    middle = np.mean(right, axis=0) if len(right) else np.zeros(width)
    with np.errstate(over="ignore", invalid="ignore"):
        x, y = left - middle, right - middle
        norms, others = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    if not (np.isfinite(norms).all() and np.isfinite(others).all()):
        yield from ((rows, gaps <= radius) for rows, gaps in distance_tiles(left, right))
        return
    x = np.column_stack([x, norms, np.ones(len(x))])
    y = np.ascontiguousarray(np.column_stack([-2.0 * y, np.ones(len(y)), others]).T)
    # More than the rounding of a product, a difference and the root.
    off = 4 * np.finfo(float).eps * (width + 8) * (norms + others.max(initial=0.0) + radius ** 2)
    step = max(1, TILE_CELLS // max(len(right), 1))
    for start in range(0, len(left), step):
        rows = slice(start, start + step)
        squares = x[rows] @ y
        near = squares <= (radius ** 2 - off[rows])[:, None]
        open_ = squares <= (radius ** 2 + off[rows])[:, None]
        if np.count_nonzero(open_) > np.count_nonzero(near):
            row, col = np.nonzero(open_ ^ near)
            exact = np.zeros(len(row))
            for j in range(width):
                gap = left[start + row, j] - right[col, j]
                exact += gap * gap
            near[row, col] = np.sqrt(exact) <= radius
        yield rows, near


def plane_tiles(
    left: np.ndarray, right: np.ndarray, mirrored: bool = False,
    left_cuts: Sequence[slice] | None = None, right_cuts: Sequence[slice] | None = None,
) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Euclidean distances of all left to all right rows, in tiles (rows, columns, distances).

    Squares come from products, |x|^2 + |y|^2 - 2xy, measured from the median of the right rows.
    Where one is small beside the norms, so that digits were lost, and where numbers are not
    finite, the differences are squared instead; a distance is right to about 1e-11 of itself,
    and to 1e-10 where nearly so many digits were lost.
    With ``mirrored``, left and right are the same rows and tiles below the diagonal are left out.
    Tiles end where the cuts do; rows of like norms side by side leave the fewest squares to look at.
    The distances lie in a buffer that the next tile uses again.
    """
    touch_buffers()
    width = left.shape[1]
    finite = np.isfinite(right).all(axis=1)
    middle = np.median(right[finite], axis=0) if finite.any() else np.zeros(width)
    with np.errstate(over="ignore", invalid="ignore"):
        x, y = left - middle, right - middle
        norms, others = (x * x).sum(axis=1), (y * y).sum(axis=1)
    # One product gives |x|^2 + |y|^2 - 2xy.
    x = np.column_stack([-2 * x, norms, np.ones(len(x))])
    y = np.column_stack([y, np.ones(len(y)), others])
    # A square below NEAR of both norms is below this, as the norms are then nearly equal.
    small = (3 * NEAR * norms + 1e-280)[:, None]
    fit, fit_others = np.isfinite(norms), np.isfinite(others)
    left_cuts, right_cuts = left_cuts or even_cuts(len(left)), right_cuts or even_cuts(len(right))
    across = [
        (cols, np.ascontiguousarray(y[cols].T), fit_others[cols].all()) for cols in right_cuts
    ]
    space, flags = np.empty(PLANE_ROWS ** 2), np.empty(PLANE_ROWS ** 2, dtype=bool)
    for rows in left_cuts:
        own, own_fit, most = x[rows], fit[rows].all(), small[rows].max()
        for cols, other, other_fit in across:
            if mirrored and cols.start < rows.start:
                continue
            shape = len(own), other.shape[1]
            cells = shape[0] * shape[1]
            squares = space[:cells].reshape(shape)
            found = cells
            if own_fit and other_fit:
                np.matmul(own, other, out=squares)
                found = 0
                if squares.min() < most:
                    near = np.less(squares, small[rows], out=flags[:cells].reshape(shape))
                    found = np.count_nonzero(near)
            if found * 16 > cells:
                squares[:] = _direct_squares(left[rows], right[cols])
            elif found:
                row, col = np.divmod(np.flatnonzero(near), shape[1])
                gap = left[rows][row] - right[cols][col]
                squares[row, col] = np.einsum("ij,ij->i", gap, gap)
            yield rows, cols, np.sqrt(squares, out=squares)


def even_cuts(rows: int, start: int = 0) -> list[slice]:
    """Slices of at most ``PLANE_ROWS`` rows, as even as can be."""
    parts = -(-rows // PLANE_ROWS)
    ends = [start + rows * i // parts for i in range(parts + 1)] if parts else []
    return [slice(one, other) for one, other in zip(ends, ends[1:])]
