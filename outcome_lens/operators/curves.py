"""Scores of a classifier on labelled rows: metrics at a threshold, curves over all of them.

Every function takes a frame with a 0/1 ``label`` and a ``score`` column; no model is needed. A row
may stand for several equal ones: ``weight`` names the column with their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import col
from outcome_lens.functions.columns import ratio, require
from outcome_lens.functions.ordering import running_totals
from outcome_lens.functions.sizes import settled

DEFAULT_THRESHOLD = 0.5


def _copies(weight: str | None) -> Column:
    return F.lit(1).cast("long") if weight is None else col(weight).cast("long")


def checked(scored: DataFrame, label: str, score: str) -> tuple[Column, Column]:
    """Score and label; a row without a label of 0 or 1, or without a score that is a number, stops the job."""
    require(scored, label, score)
    bad = col(score).isNull() | F.isnan(col(score).cast("double")) | col(label).isNull() | ~col(label).isin(0, 1)
    message = F.lit("a row to be evaluated has a score that is no number, or a label other than 0 and 1")
    return F.when(bad, F.raise_error(message).cast("double")).otherwise(col(score).cast("double")), col(label).cast("long")


def confusion(
    scored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """One row ``(tn, fp, fn, tp)``; a score at the threshold is predicted positive."""
    number, truth = checked(scored, label, score)
    hit = number >= F.lit(float(threshold))
    real = truth == 1

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, _copies(weight))), F.lit(0))

    return scored.agg(
        rows(~real & ~hit).alias("tn"),
        rows(~real & hit).alias("fp"),
        rows(real & ~hit).alias("fn"),
        rows(real & hit).alias("tp"),
    )


def metric_columns() -> list[Column]:
    """Accuracy, precision, recall and F1 from the four counts; 0 where one is undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return [
        ratio(tp + tn, tp + tn + fp + fn, 0).alias("accuracy"),
        ratio(tp, tp + fp, 0).alias("precision"),
        ratio(tp, tp + fn, 0).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn, 0).alias("f1"),
    ]


def classification_metrics(
    scored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    counts = confusion(scored, threshold, label, score, weight)
    return counts.select(F.lit(float(threshold)).alias("threshold"), "*", *metric_columns())


def _by_score(scored: DataFrame, label: str, score: str, weight: str | None) -> DataFrame:
    """Per distinct score its rows, and the rows at or above it."""
    number, truth = checked(scored, label, score)
    counts = scored.groupBy(number.alias("score")).agg(
        F.sum(truth * _copies(weight)).alias("pos"), F.sum(_copies(weight)).alias("n")
    )
    return running_totals(
        counts, [], [F.col("score").desc()], {"tp": F.col("pos"), "_above": F.col("n")}
    ).withColumn("fp", F.col("_above") - F.col("tp"))


def _totals(by_score: DataFrame) -> Column:
    return by_score.agg(
        F.struct(F.coalesce(F.sum("pos"), F.lit(0)).alias("pos"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    ).scalar()


def pr_curve(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """Rows ``(threshold, tp, fp, precision, recall, f1)``, one per distinct score."""
    by_score = _by_score(scored, label, score, weight)
    positives = _totals(by_score)["pos"]
    return by_score.select(
        F.col("score").alias("threshold"), "tp", "fp", (positives - F.col("tp")).alias("fn")
    ).select(
        "threshold",
        "tp",
        "fp",
        ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn"), 0).alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"), 0).alias("f1"),
    )


def ranking_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """One row ``(positives, negatives, roc_auc, average_precision)``; equal scores are exact ties.

    ROC-AUC is the share of (positive, negative) pairs in the right order, ties counting half; it is
    NULL when there is only one class. Average precision is the step sum over the curve.
    """
    by_score = _by_score(scored, label, score, weight)
    total = _totals(by_score)
    pos, neg = total["pos"].cast("double"), (total["n"] - total["pos"]).cast("double")
    own_neg = (F.col("n") - F.col("pos")).cast("double")
    below = neg - F.col("fp").cast("double")
    right = F.sum(F.col("pos") * (below + own_neg / 2))
    steps = F.sum(F.col("pos") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp")))
    sums = by_score.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum(F.col("n") - F.col("pos")), F.lit(0)).alias("negatives"),
        right.alias("_right"),
        steps.alias("_steps"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        "positives",
        "negatives",
        ratio(F.col("_right"), pairs).alias("roc_auc"),
        ratio(F.col("_steps"), F.col("positives")).alias("average_precision"),
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(scored, label, score).select("positives", "negatives", "roc_auc")


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(scored, label, score).select("positives", "negatives", "average_precision")


def best_f1_threshold(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """One row ``(threshold, f1)``: the score with the largest F1, the lowest of a tie; 0.5 without rows."""
    curve = pr_curve(scored, label, score, weight)
    best = curve.agg(F.min(F.struct((-F.col("f1")).alias("minus"), "threshold")).alias("_best"))
    return best.select(
        F.coalesce("_best.threshold", F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.coalesce(-F.col("_best.minus"), F.lit(0.0)).alias("f1"),
    )


def compare_thresholds(
    out_of_fold: DataFrame,
    test: DataFrame,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
) -> DataFrame:
    """Two rows: all metrics on ``test`` at 0.5, and at the threshold that is best out of fold."""
    row = best_f1_threshold(out_of_fold, label, score, weight=weight).first()
    ranks = ranking_metrics(test, label, score, weight=weight).first()

    def at(kind: str, threshold: float) -> DataFrame:
        return classification_metrics(test, threshold, label, score, weight).select(
            F.lit(kind).alias("kind"),
            "*",
            F.lit(ranks["roc_auc"]).cast("double").alias("roc_auc"),
            F.lit(ranks["average_precision"]).cast("double").alias("average_precision"),
        )

    return settled(at("default", DEFAULT_THRESHOLD).unionByName(at("tuned", row["threshold"])))
