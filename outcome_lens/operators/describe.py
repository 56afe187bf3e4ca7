"""Summary statistics of columns, correlations, and both ends of a sorted table."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.blocks import BLOCK, packed, tree_merge
from outcome_lens.functions.columns import number, numeric_columns, require, same_keys, to_rows
from outcome_lens.functions.profiles import Profile, exact_quantiles, profile, sketched

BLOCK_CELLS = 1_000_000  # cells of the table that a task holds at once as a matrix
ROUNDING = 1e-14  # of a sum of squares: a spread below it is that of a constant
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe_numeric(
    df: DataFrame, names: Sequence[str] | None = None, exact: bool = True, known: Profile | None = None
) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, extremes, quartiles.

    ``known`` is a profile of the columns that was made before; without it, one more scan makes one. ``exact=False`` leaves the
    quartiles to the sketch, and the table is scanned once.
    """
    names = numeric_columns(df) if names is None else list(names)
    require(df, *names)
    if not names:
        raise AnalysisError("the table has no numeric column")
    known = known or profile(df, names)
    moments = known.rows.filter(F.col("column").isin(names)).select("column", F.col("n").alias("count"), "mean", "std", "min", "max", "grid", "n")
    if exact:
        cuts = exact_quantiles(df, known, QUARTILES)
    else:
        cuts = moments.select("column", *[F.when(F.col("n") > 0, sketched(F.lit(p))).alias(q) for q, p in QUARTILES.items()])
    return same_keys(moments, cuts, ["column"]).select("column", "count", "mean", "std", "min", *QUARTILES, "max")


def describe_all(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per column: count, and for a non-numeric one its distinct levels and commonest level.

    The commonest level of a tie is the smallest.
    """
    names = list(df.columns if names is None else names)
    require(df, *names)
    numeric = set(numeric_columns(df))
    texts = [n for n in names if n not in numeric]
    entries = [n for n in names if n in numeric]
    parts = []
    if texts:
        counts = to_rows(df, texts).groupBy("column", "level").agg(F.count(F.lit(1)).alias("_n"))
        present = F.col("level").isNotNull()
        parts.append(
            counts.groupBy("column")
            .agg(
                F.coalesce(F.sum(F.when(present, F.col("_n"))), F.lit(0)).alias("count"),
                F.count_if(present).alias("unique"),
                F.min(F.when(present, F.struct((-F.col("_n")).alias("n"), F.col("level").alias("l")))).alias("_top"),
            )
            .select("column", "count", "unique", F.col("_top.l").alias("top"), (-F.col("_top.n")).alias("freq"))
        )
    if entries:
        one = df.agg(
            *[F.struct(F.lit(n).alias("column"), F.count(number(df, n)).alias("count")).alias(f"_{i}") for i, n in enumerate(entries)]
        )
        parts.append(
            one.select(F.explode(F.array(*[f"_{i}" for i in range(len(entries))])).alias("_e"))
            .select("_e.*")
            .select(
                "*",
                F.lit(None).cast("long").alias("unique"),
                F.lit(None).cast("string").alias("top"),
                F.lit(None).cast("long").alias("freq"),
            )
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def co_moments(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """Pairwise-complete moments as an array of four squares, in one scan.

    For columns i and j, over the rows where both have a value: their number, the mean of i, the sum of squared deviations of i, and
    the sum of products of deviations. A task works on blocks of rows as matrices and sends its squares once, packed; squares are merged
    in a tree, by the update for two disjoint parts.
    """
    require(df, *names)
    width = len(names)
    cells = df.select(*[number(df, n).alias(f"x{i}") for i, n in enumerate(names)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 * width * width)
        block = max(1, BLOCK_CELLS // width)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.slice(at, block).columns])
                total = _merged_moments(total, _block_moments(x).ravel())
        yield packed(total)

    found = tree_merge(cells.mapInArrow(gather, BLOCK), _merged_moments)
    return (np.zeros(4 * width * width) if found is None else found).reshape(4, width, width)


def _block_moments(x: np.ndarray) -> np.ndarray:
    """The four squares of the rows of ``x``, NaN being no value."""
    has = ~np.isnan(x)
    x = np.where(has, x, 0.0)
    counts = has.sum(0)
    least, most = np.where(has, x, np.inf).min(0), np.where(has, x, -np.inf).max(0)
    # a constant column is shifted by its value, which leaves exact zeros
    shift = np.where(least == most, least, x.sum(0) / np.maximum(counts, 1))
    shift = np.where(np.isfinite(shift), shift, 0.0)
    x = np.where(has, x - shift, 0.0)
    there = has.astype(float)
    n, sums, squares = there.T @ there, x.T @ there, (x * x).T @ there
    mean = sums / np.maximum(n, 1)
    spread = squares - sums * mean
    spread[spread < ROUNDING * squares] = 0.0
    return np.stack([n, shift[:, None] + mean, spread, x.T @ x - sums * mean.T])


def _merged_moments(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    width = math.isqrt(len(one) // 4)
    (n, mean, spread, joint), (m, other, wide, both) = one.reshape(4, width, width), two.reshape(4, width, width)
    total = n + m
    share = m / np.maximum(total, 1)
    apart = other - mean
    weight = n * share
    centre = np.where(n == 0, other, mean + apart * share)
    return np.stack([total, centre, spread + wide + apart**2 * weight, joint + both + apart * apart.T * weight]).ravel()


def correlation(df: DataFrame, names: Sequence[str] | None = None, triangle: str = "full") -> DataFrame:
    """Rows ``(a, b, r, n)``: Pearson over the rows where both columns have a value.

    ``triangle="lower"`` leaves out the diagonal and one of each mirrored pair. All pairs share one
    scan; r is NULL where a column does not vary.
    """
    if triangle not in ("full", "lower"):
        raise AnalysisError(f"triangle is full or lower, not {triangle!r}")
    names = numeric_columns(df) if names is None else list(names)
    if not names or (triangle == "lower" and len(names) < 2):
        raise AnalysisError("a correlation needs at least two columns")
    n, _, spread, joint = co_moments(df, names)
    scale = np.sqrt(spread) * np.sqrt(spread.T)
    i, j = np.indices(n.shape).reshape(2, -1) if triangle == "full" else np.tril_indices(len(names), -1)
    r = np.divide(joint, scale, out=np.full(n.shape, np.nan), where=scale != 0)
    text = pa.array(names, pa.string())
    columns = [text.take(pa.array(i)), text.take(pa.array(j)), pa.array(r[i, j], mask=scale[i, j] == 0), pa.array(n[i, j].astype(np.int64))]
    return df.sparkSession.createDataFrame(pa.table(columns, names=["a", "b", "r", "n"]))


def top_bottom(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` largest and the ``k`` smallest rows of ``by``, with their place at each end."""
    require(df, by, *tie_break)
    rest = [col(t).asc() for t in tie_break]

    def end(name: str, first) -> DataFrame:
        best = df.filter(col(by).isNotNull()).orderBy(first, *rest).limit(k)
        place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(first, *rest))
        return best.select(F.lit(name).alias("end"), place.alias("place"), "*")

    return end("top", col(by).desc()).unionByName(end("bottom", col(by).asc()))


__all__ = ["correlation", "describe_all", "describe_numeric", "top_bottom"]
