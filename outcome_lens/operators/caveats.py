"""Limits of the data that have to be read along with any result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import Outcome, col
from outcome_lens.functions.columns import number, ratio, require


def topcode_profile(df: DataFrame, name: str, cap: float, outcome: Outcome) -> DataFrame:
    """One row: rows at the cap, the positive rate among them (0 if none), the share of zeros."""
    require(df, name, outcome.column)
    value = number(df, name)
    at_cap = F.coalesce(value == cap, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(at_cap).alias("capped_rows"),
        F.coalesce(F.avg(F.when(at_cap, outcome.flag())), F.lit(0.0)).alias("capped_positive_rate"),
        ratio(F.count_if(value == 0), F.count(F.lit(1))).alias("zero_share"),
    ).select(F.lit(name).alias("column"), F.lit(float(cap)).alias("cap"), "*")


def level_purity(
    df: DataFrame, of: str, given: str, levels: Sequence[str] | None = None
) -> DataFrame:
    """Per level of ``given``: the commonest level of ``of`` in it, and that level's share."""
    require(df, of, given)
    rows = df.filter(col(given).isNotNull() & col(of).isNotNull())
    if levels is not None:
        rows = rows.filter(col(given).isin(list(levels)))
    counts = rows.groupBy(col(given).cast("string").alias("level"), col(of).cast("string").alias("_of")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.groupBy("level").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("_of").alias("of"))).alias("_top"),
        F.sum("_n").alias("n"),
    ).select(
        "level", F.col("_top.of").alias("dominant"), ratio(-F.col("_top.n"), F.col("n")).alias("share"), "n"
    )
