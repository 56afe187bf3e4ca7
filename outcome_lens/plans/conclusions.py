"""Statements derived from result tables: change a number and the statement changes with it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError

TIE_GAP = 0.01  # an F1 difference below this gives no ranking


def strategy_verdict(scores: DataFrame, gap: float = TIE_GAP) -> DataFrame:
    """One row over ``(strategy, f1)`` rows: the winner, or a tie when the spread is below ``gap``."""
    best = F.min(F.struct((-F.col("f1")).alias("minus"), F.col("strategy").alias("strategy")))
    facts = scores.agg(
        best.alias("_best"), F.min("f1").alias("worst_f1"), F.count(F.lit(1)).alias("strategies")
    ).select("_best.strategy", (-F.col("_best.minus")).alias("best_f1"), "worst_f1", "strategies")
    spread = F.col("best_f1") - F.col("worst_f1")
    tie = (F.col("strategies") > 1) & (spread < gap)
    return facts.select(
        "strategies",
        "best_f1",
        "worst_f1",
        spread.alias("gap"),
        tie.alias("tie"),
        F.when(~tie, F.col("strategy")).alias("winner"),
        F.when(tie, F.lit("no ranking")).otherwise(F.concat(F.lit("best: "), "strategy")).alias("verdict"),
    )


def strongest(coefs: DataFrame) -> DataFrame:
    """The coefficient row with the largest absolute value."""
    rest = [c for c in coefs.columns if c != "name"]
    first = F.min(F.struct((-F.abs("coef")).alias("minus"), F.col("name"), *rest)).alias("_top")
    return coefs.agg(first).select(*[F.col(f"_top.{c}").alias(c) for c in coefs.columns])


def equality_verdict(summary: DataFrame) -> DataFrame:
    """A comparison summary with ``verdict``: identical, or which kinds of mismatch there are."""
    parts = F.format_string(
        "types %d, nulls %d, values %d", "type_mismatch", F.coalesce("null_mismatch", F.lit(-1)), F.coalesce("value_mismatch", F.lit(-1))
    )
    text = (
        F.when(F.col("identical"), F.lit("identical"))
        .when(~F.col("columns_match") | ~F.col("rows_match"), F.lit("not comparable"))
        .otherwise(F.concat(F.lit("mismatches: "), parts))
    )
    return summary.withColumn("verdict", text)


def reader_equality(split: str, left_rows: int, right_rows: int, difference: DataFrame) -> DataFrame:
    """One row: whether two reads of a file gave the same rows. Different numbers of rows are an error.

    ``difference`` holds the rows whose numbers of copies differ.
    """
    if left_rows != right_rows:
        raise AnalysisError(f"{split}: one reader found {left_rows} rows and the other {right_rows}")
    rows = difference.agg(F.coalesce(F.sum(F.abs(F.col("left_copies") - F.col("right_copies"))), F.lit(0)).alias("n"))
    return rows.select(
        F.lit(split).alias("split"),
        F.lit(left_rows).cast("long").alias("rows"),
        F.col("n").alias("differing_rows"),
        F.when(F.col("n") == 0, "identical").otherwise("different").alias("verdict"),
    )


def _fact(fact: str, item: Column, value: Column, low=None, high=None, verdict=None) -> list[Column]:
    def real(c):
        return (F.lit(None) if c is None else c).cast("double")

    return [
        F.lit(fact).alias("fact"),
        item.cast("string").alias("item"),
        real(value).alias("value"),
        real(low).alias("low"),
        real(high).alias("high"),
        (F.lit(None) if verdict is None else verdict).cast("string").alias("verdict"),
    ]


def conclusions(
    chi_square: DataFrame | None = None,
    welch: DataFrame | None = None,
    rates: DataFrame | None = None,
    coefs: DataFrame | None = None,
    focus: str | None = None,
    sensitivity: DataFrame | None = None,
    thresholds: DataFrame | None = None,
    strategies: DataFrame | None = None,
    readers: DataFrame | None = None,
    references: DataFrame | None = None,
) -> DataFrame:
    """Rows ``(fact, item, value, low, high, verdict)`` from the results of the steps before.

    With ``references`` (``column, level, n``), what every level is compared with is a fact, and so is each contrast of the
    focus against its reference; a focus without a coefficient has a contrast without numbers.
    """
    none = F.lit("")
    parts: list[DataFrame] = []
    if chi_square is not None:
        verdict = F.when(F.col("significant"), "dependent").otherwise("independence not rejected")
        parts.append(chi_square.select(*_fact("independence", none, F.col("cramers_v"), verdict=verdict)))
    if welch is not None:
        verdict = F.when(F.col("significant"), "different").otherwise("no difference shown")
        parts.append(
            welch.select(*_fact("mean difference", none, F.col("diff"), F.col("ci_low"), F.col("ci_high"), verdict))
        )
        parts.append(welch.select(*_fact("effect size", none, F.col("cohens_d"), verdict=F.col("effect"))))
    if rates is not None:
        parts.append(
            rates.filter("kind = 'level'").select(*_fact("outcome rate", F.concat_ws("=", "column", "level"), F.col("ratio")))
        )
    crosses_one = F.when((F.col("or_low") <= 1) & (F.col("or_high") >= 1), "direction open").otherwise(
        F.when(F.col("odds_ratio") > 1, "raises the odds").otherwise("lowers the odds")
    )
    odds = (F.col("odds_ratio"), F.col("or_low"), F.col("or_high"), crosses_one)
    if coefs is not None:
        parts.append(strongest(coefs).select(*_fact("strongest term", F.col("name"), *odds)))
        if focus is not None:
            terms = coefs.filter(F.col("feature") == focus)
            parts.append(terms.select(*_fact("focus term", F.col("name"), *odds)))
            if references is not None:
                base = references.filter(F.col("column") == focus).select(F.col("level").alias("_base"))
                text = F.concat(F.lit(f"{focus}: "), "level", F.lit(" against "), "_base")
                told = F.when(F.col("level").isNull(), F.lit("not in the model")).otherwise(crosses_one)
                contrasts = base.join(terms, F.lit(True), "left")
                parts.append(contrasts.select(*_fact("focus contrast", F.coalesce(text, F.lit(focus)), *odds[:3], told)))
    if sensitivity is not None:
        item = F.concat("name", F.lit(" without "), "excluded")
        parts.append(sensitivity.select(*_fact("sensitivity", item, *odds)))
    if thresholds is not None:
        parts.append(thresholds.select(*_fact("missed positives", F.col("kind"), F.col("fn"))))
        parts.append(thresholds.select(*_fact("recall", F.col("kind"), F.col("recall"))))
        parts.append(thresholds.filter("kind = 'tuned'").select(*_fact("tuned threshold", none, F.col("threshold"))))
        change = F.sum(F.when(F.col("kind") == "tuned", F.col("fn")).otherwise(-F.col("fn")))
        change_verdict = F.when(change < 0, "fewer missed").when(change > 0, "more missed").otherwise("same")
        parts.append(thresholds.agg(change.alias("_c"), change_verdict.alias("_v")).select(*_fact("change in missed positives", none, F.col("_c"), verdict=F.col("_v"))))
    if strategies is not None:
        parts.append(
            strategy_verdict(strategies).select(*_fact("strategy gap", none, F.col("gap"), verdict=F.col("verdict")))
        )
    if references is not None:
        parts.append(references.select(*_fact("reference", F.col("column"), F.col("n"), verdict=F.col("level"))))
    if readers is not None:
        parts.append(readers.select(*_fact("readers", F.col("split"), F.col("differing_rows"), verdict=F.col("verdict"))))
    if not parts:
        raise AnalysisError("no result to conclude from")
    return reduce(DataFrame.unionByName, parts)
