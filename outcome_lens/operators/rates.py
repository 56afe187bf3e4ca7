"""Outcome rates per category level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcome_lens.contract import Outcome, col
from outcome_lens.functions.columns import ratio, require, same_keys, to_rows
from outcome_lens.functions.ordering import running_totals
from outcome_lens.session import durable

FOLD_ABOVE = 20  # levels a panel may have before its rare levels are folded
FOLD_KEEP = 14


def outcome_rate(
    df: DataFrame, names: Sequence[str], outcome: Outcome, order_by: str | None = None
) -> DataFrame:
    """Rows ``(kind, column, level, positives, n, ratio)`` for any number of columns at once.

    ``kind="overall"`` is the rate of the whole table, the line a level is read against; a row
    without a level counts there only. ``order_by`` adds ``position``, the least value of a
    companion column in each level, for levels that have an order of their own.
    """
    require(df, *names, outcome.column, *([order_by] if order_by else []))
    base = df.select(
        *[col(n) for n in names],
        outcome.flag().cast("long").alias("_flag"),
        *([col(order_by).cast("double").alias("_position")] if order_by else []),
    )
    keep = ["_flag", "_position"] if order_by else ["_flag"]
    sums = [F.sum("_flag").alias("positives"), F.count(F.lit(1)).alias("n")]
    if order_by:
        sums.append(F.min("_position").alias("position"))
    levels = to_rows(base, names, keep).groupBy("column", "level").agg(*sums)
    # the totals come from the level rows, not from a second read; every column splits the same rows,
    # so the levels of any one column add up to the whole table
    again = [F.sum("positives").alias("positives"), F.sum("n").alias("n")]
    if order_by:
        again.append(F.min("position").alias("position"))
    both = levels.groupingSets(
        [[F.col("column"), F.col("level")], [F.col("column")]], F.col("column"), F.col("level")
    ).agg(F.grouping("level").alias("_total"), *again)
    is_total = F.col("_total") == 1
    return both.filter(F.when(is_total, F.col("column") == names[0]).otherwise(F.col("level").isNotNull())).select(
        F.when(is_total, "overall").otherwise("level").alias("kind"),
        F.when(~is_total, F.col("column")).alias("column"),
        "level",
        "positives",
        "n",
        ratio(F.col("positives"), F.col("n")).alias("ratio"),
        *([F.when(~is_total, F.col("position")).alias("position")] if order_by else []),
    )


def rank_levels(rates: DataFrame) -> DataFrame:
    """Add ``rank`` by ascending rate within each column; equal rates go by level."""
    levels = rates.filter(F.col("level").isNotNull()) if "kind" not in rates.columns else rates.filter("kind = 'level'")
    return running_totals(levels, ["column"], [F.col("ratio").asc(), F.col("level").asc()], {"rank": F.lit(1).cast("long")})


def fold_rare(rates: DataFrame, above: int = FOLD_ABOVE, keep: int = FOLD_KEEP) -> DataFrame:
    """Where a column has more than ``above`` levels, keep the ``keep`` largest and merge the rest.

    Rows ``(column, level, folded, positives, n, ratio)``; the merged row is named ``other K``, K the
    number of levels in it, and its rate is that of all their rows.
    """
    # one row per level, read by three steps: written once, so the table behind it is not read again
    levels = durable(rates.filter("kind = 'level'") if "kind" in rates.columns else rates)
    largest = W.partitionBy("column").orderBy(F.col("n").desc(), F.col("level").asc())
    totals = levels.groupBy("column").agg(
        F.count(F.lit(1)).alias("_levels"), F.sum("positives").alias("_positives"), F.sum("n").alias("_n")
    )
    # a window that is cut at a fixed rank keeps only that many rows per task before its shuffle
    first = levels.withColumn("_place", F.row_number().over(largest)).filter(F.col("_place") <= max(above, keep))
    kept = same_keys(first, totals, ["column"]).filter((F.col("_levels") <= above) | (F.col("_place") <= keep))
    rest = (
        kept.filter(F.col("_levels") > above)
        .groupBy("column", "_levels", "_positives", "_n")
        .agg(F.sum("positives").alias("_top_positives"), F.sum("n").alias("_top_n"), F.count(F.lit(1)).alias("_top"))
        .select(
            "column",
            F.concat(F.lit("other "), (F.col("_levels") - F.col("_top")).cast("string")).alias("level"),
            (F.col("_levels") - F.col("_top")).alias("folded"),
            (F.col("_positives") - F.col("_top_positives")).alias("positives"),
            (F.col("_n") - F.col("_top_n")).alias("n"),
        )
        .filter("folded > 0")
    )
    named = kept.select("column", "level", F.lit(0).cast("long").alias("folded"), "positives", "n")
    return named.unionByName(rest).withColumn("ratio", ratio(F.col("positives"), F.col("n")))
