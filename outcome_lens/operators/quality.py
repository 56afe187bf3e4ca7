"""Missing cells, duplicates, and what removing them does to the outcome groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcome_lens.contract import AnalysisError, Outcome, col
from outcome_lens.functions.columns import any_missing, missing, ratio, require

DROP = "drop"
UNKNOWN = "unknown"
UNKNOWN_LEVEL = "Unknown"


def null_profile(df: DataFrame) -> DataFrame:
    """Rows ``(column, nulls, rows)`` for the columns that have any missing cell, in one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(df, n)).alias(f"_{i}") for i, n in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(n).alias("column"), F.col(f"_{i}").alias("nulls"), F.col("_rows").alias("rows"))
        for i, n in enumerate(df.columns)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").filter("nulls > 0")


def missingness_impact(df: DataFrame, outcome: Outcome) -> DataFrame:
    """How unevenly dropping incomplete rows hits the outcome groups.

    ``kind="group"`` rows: total, removed and drop rate per label. The ``kind="overall"`` row:
    all rows, a missing label included, and the positive rate before and after (NULL if no row is
    kept).
    """
    require(df, outcome.column)
    flagged = df.select(
        F.when(~missing(df, outcome.column), col(outcome.column)).cast("string").alias("group"),
        any_missing(df).cast("long").alias("_gone"),
        outcome.flag().cast("long").alias("_positive"),
    )
    groups = flagged.groupBy("group").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("_gone").alias("removed"),
        F.sum("_positive").alias("_positive"),
        F.sum(F.col("_positive") * (1 - F.col("_gone"))).alias("_kept"),
    )
    # the overall row adds up the groups, so the table is read once
    sums = groups.groupingSets([[F.col("group")], []], F.col("group")).agg(
        F.grouping("group").alias("_all"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "removed", "_positive", "_kept")],
    )
    is_all = F.col("_all") == 1
    return sums.filter(is_all | F.col("group").isNotNull()).select(
        F.when(is_all, "overall").otherwise("group").alias("kind"),
        "group",
        "total",
        "removed",
        ratio(F.col("removed"), F.col("total")).alias("drop_rate"),
        F.when(is_all, ratio(F.col("_positive"), F.col("total"))).alias("rate_before"),
        F.when(is_all, ratio(F.col("_kept"), F.col("total") - F.col("removed"))).alias("rate_after"),
    )


def fill_unknown(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Missing categories as a level of their own; a category that is not a string column is an error."""
    require(df, *categorical)
    others = [c for c in categorical if not isinstance(df.schema[c].dataType, T.StringType)]
    if others:
        raise AnalysisError(f"categories must be string columns to get a level of their own: {', '.join(others)}")
    return df.na.fill({c: UNKNOWN_LEVEL for c in categorical}) if categorical else df


def _prepared(df: DataFrame, strategy: str, categorical: Sequence[str]) -> DataFrame:
    if strategy == DROP:
        return df
    if strategy == UNKNOWN:
        return fill_unknown(df, categorical)
    raise AnalysisError(f"strategy is {DROP} or {UNKNOWN}, not {strategy!r}")


def clean(df: DataFrame, strategy: str = DROP, categorical: Sequence[str] = ()) -> DataFrame:
    """Complete, distinct rows. ``unknown`` first gives missing categories a level of their own."""
    return dedup(_prepared(df, strategy, categorical).na.drop("any"))


def funnel(df: DataFrame, strategy: str = DROP, categorical: Sequence[str] = ()) -> DataFrame:
    """One row: rows before cleaning, rows complete after ``strategy``, rows left after dedup.

    One grouping over whole rows gives all three numbers.
    """
    filled = _prepared(df, strategy, categorical)
    copies = filled.groupBy(*[col(n) for n in filled.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    complete = ~any_missing(filled)
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(complete, F.col("_copies"))), F.lit(0)).alias("complete"),
        F.count_if(complete).alias("clean"),
    ).select(F.lit(strategy).alias("strategy"), "raw", "complete", "clean")


def dedup(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct combination of ``names`` (all columns by default); NULL equals NULL.

    With ``names`` only those columns are returned: which of several rows would be kept is not
    determined in a distributed table.
    """
    chosen = df if names is None else df.select(*[col(n) for n in names])
    return chosen.dropDuplicates()


def cleaning_summary(
    splits: Mapping[str, DataFrame],
    outcome: Outcome,
    strategy: str = DROP,
    categorical: Sequence[str] = (),
) -> DataFrame:
    """All cleaning numbers of several splits as rows ``(split, measure, item, value)``."""
    def long(split: str, df: DataFrame) -> list[DataFrame]:
        steps = funnel(df, strategy, categorical).select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit("rows").alias("measure"), F.lit(s).alias("item"), F.col(s).cast("double").alias("value"))
                        for s in ("raw", "complete", "clean")
                    ]
                )
            ).alias("_e")
        ).select("_e.*")
        nulls = null_profile(df).select(
            F.lit("nulls").alias("measure"), F.col("column").alias("item"), F.col("nulls").cast("double").alias("value")
        )
        impact = missingness_impact(df, outcome).select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(m).alias("measure"),
                            F.coalesce(F.col("group"), F.lit("")).alias("item"),
                            F.col(m).cast("double").alias("value"),
                        )
                        for m in ("total", "removed", "drop_rate", "rate_before", "rate_after")
                    ]
                )
            ).alias("_e")
        ).select("_e.*").filter(F.col("value").isNotNull())
        return [part.select(F.lit(split).alias("split"), "*") for part in (steps, nulls, impact)]

    parts = [part for split, df in splits.items() for part in long(split, df)]
    if not parts:
        raise AnalysisError("no split to summarise")
    return reduce(DataFrame.unionByName, parts)
