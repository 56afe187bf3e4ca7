"""Category levels: counts, reference levels, contingency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.columns import require, same_keys, to_rows

MOST_CELLS = 1_000_000  # pairs of levels that a full contingency table may have


def level_counts(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Rows ``(column, level, n)``; a missing cell is no level."""
    return (
        to_rows(df, categorical)
        .filter(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reference_levels(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Per column the commonest level, the smallest of a tie: what other levels are compared with."""
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("level").alias("level"))).alias("_best")
    return (
        level_counts(df, categorical)
        .groupBy("column")
        .agg(best, F.count(F.lit(1)).alias("levels"))
        .select("column", F.col("_best.level").alias("level"), (-F.col("_best.n")).alias("n"), "levels")
    )


def crosstab(df: DataFrame, a: str, b: str, zero_cells: bool = True) -> DataFrame:
    """Rows ``(a, b, observed, expected)`` for the pairs of levels that occur, and with ``zero_cells`` for all pairs.

    All pairs are as many as the product of the levels; over ``MOST_CELLS`` that is an error.
    """
    require(df, a, b)
    pairs = (
        df.filter(col(a).isNotNull() & col(b).isNotNull())
        .groupBy(col(a).cast("string").alias("a"), col(b).cast("string").alias("b"))
        .agg(F.count(F.lit(1)).alias("observed"))
    )
    row_sums = pairs.groupBy("a").agg(F.sum("observed").alias("_row"))
    column_sums = pairs.groupBy("b").agg(F.sum("observed").alias("_column"))
    total = pairs.agg(F.sum("observed").alias("n")).scalar()
    if zero_cells:
        levels = column_sums.limit(MOST_CELLS + 1).count()
        if row_sums.limit(MOST_CELLS + 1).count() * levels > MOST_CELLS:
            raise AnalysisError(f"{a} and {b} have more than {MOST_CELLS} pairs of levels: leave out those that do not occur")
        listed = column_sums.agg(F.array_sort(F.collect_list("b")).alias("levels")).scalar()
        grid = row_sums.select("a", F.explode(listed).alias("b"))
        pairs = same_keys(grid, pairs, ["a", "b"], "left")
    cells = same_keys(same_keys(pairs, row_sums, ["a"]), column_sums, ["b"])
    return cells.select(
        "a",
        "b",
        F.coalesce("observed", F.lit(0)).alias("observed"),
        (F.col("_row").cast("double") * F.col("_column") / total).alias("expected"),
    )
