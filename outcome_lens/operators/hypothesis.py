"""Tests of group differences, with the effect size next to every p."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.columns import number, ratio, require, same_keys
from outcome_lens.functions.formats import effect_label, p_text
from outcome_lens.functions.tails import chi2_test, t_test

ALPHA = 0.05


def _verdict_columns(p: Column, log10_p: Column, alpha: float) -> list[Column]:
    return [
        p.alias("p"),
        log10_p.alias("log10_p"),
        p_text(p).alias("p_text"),
        (p == 0).alias("p_underflow"),
        (p < alpha).alias("significant"),
    ]


def welch_statistics(
    df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = ()
) -> DataFrame:
    """Size, mean and variance of both groups, and the t statistic, its degrees of freedom, Cohen's d.

    One aggregate of mergeable moments per segment; d is NULL where a group has fewer than 2 rows
    and 0 where both groups are constant.
    """
    require(df, value, group, *by)
    x = number(df, value)
    in_a, in_b = col(group) == F.lit(a), col(group) == F.lit(b)
    moments = df.groupBy(*[col(s) for s in by]).agg(
        F.count(F.when(in_a, x)).alias("n_a"),
        F.count(F.when(in_b, x)).alias("n_b"),
        F.avg(F.when(in_a, x)).alias("mean_a"),
        F.avg(F.when(in_b, x)).alias("mean_b"),
        F.var_samp(F.when(in_a, x)).alias("var_a"),
        F.var_samp(F.when(in_b, x)).alias("var_b"),
    )
    share_a, share_b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    spread = share_a + share_b
    diff = F.col("mean_a") - F.col("mean_b")
    enough = (F.col("n_a") >= 2) & (F.col("n_b") >= 2)
    pooled = F.sqrt(
        ((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"))
        / (F.col("n_a") + F.col("n_b") - 2)
    )
    dof = ratio(
        F.pow(spread, F.lit(2)),
        F.pow(share_a, F.lit(2)) / (F.col("n_a") - 1) + F.pow(share_b, F.lit(2)) / (F.col("n_b") - 1),
    )
    return moments.select(
        "*",
        diff.alias("diff"),
        F.when(enough, F.sqrt(spread)).alias("se"),
        F.when(enough, ratio(diff, F.sqrt(spread))).alias("t"),
        F.when(enough, dof).alias("dof"),
        F.when(enough, ratio(diff, pooled, otherwise=0)).alias("cohens_d"),
    )


def welch_t(
    df: DataFrame, value: str, group: str, a, b, by: Sequence[str] = (), alpha: float = ALPHA
) -> DataFrame:
    """Welch's t test of the mean of ``value`` in group ``a`` against group ``b``, per segment.

    Without segments an empty group is an error; a segment that lacks one is left untested (NULLs).
    """
    stats = welch_statistics(df, value, group, a, b, by)
    if not by:
        # one row: its moments are kept, so the table is read once
        row = stats.first()
        if row["n_a"] == 0 or row["n_b"] == 0:
            raise AnalysisError(f"an empty group: {a} has {row['n_a']} rows, {b} has {row['n_b']}")
        stats = df.sparkSession.createDataFrame([row], stats.schema)  # as ``settled``, after the check
    tested = stats.select("*", t_test(F.col("t"), F.col("dof"), alpha).alias("_test"))
    half = F.col("_test.critical") * F.col("se")
    return tested.select(
        *stats.columns,
        (F.col("diff") - half).alias("ci_low"),
        (F.col("diff") + half).alias("ci_high"),
        effect_label(F.col("cohens_d")).alias("effect"),
        *_verdict_columns(F.col("_test.p"), F.col("_test.log10_p"), alpha),
    )


def chi_square_statistics(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Chi-square statistic (no continuity correction), dof, n, least expected count, Cramer's V.

    Sums run over the cells that occur. A cell that does not occur adds its expected count, and
    those counts together are n less the expected counts of the others, so no grid is built.
    """
    require(df, a, b, *by)
    segment = [col(s) for s in by]
    cells = (
        df.filter(col(a).isNotNull() & col(b).isNotNull())
        .groupBy(*segment, col(a).alias("_a"), col(b).alias("_b"))
        .agg(F.count(F.lit(1)).cast("double").alias("_o"))
    )

    def margin(level: str, name: str) -> DataFrame:
        return cells.groupBy(*segment, level).agg(F.sum("_o").alias(name))

    rows, columns = margin("_a", "_row"), margin("_b", "_column")

    def facts(sums: DataFrame, name: str, tag: str) -> DataFrame:
        return sums.groupBy(*segment).agg(
            F.count(F.lit(1)).alias(f"_levels_{tag}"), F.min(name).alias(f"_least_{tag}"), F.sum(name).alias(f"_n_{tag}")
        )

    priced = same_keys(same_keys(cells, rows, [*by, "_a"]), columns, [*by, "_b"])
    if by:
        totals = same_keys(facts(rows, "_row", "a"), facts(columns, "_column", "b"), by)
        priced = same_keys(priced, totals, by)
        group = [*segment]
    else:
        one_a = facts(rows, "_row", "a").agg(F.first(F.struct("_levels_a", "_least_a", "_n_a"))).scalar()
        one_b = facts(columns, "_column", "b").agg(F.first(F.struct("_levels_b", "_least_b"))).scalar()
        priced = priced.select(
            "*",
            *[one_a[c].alias(c) for c in ("_levels_a", "_least_a", "_n_a")],
            *[one_b[c].alias(c) for c in ("_levels_b", "_least_b")],
        )
        group = []
    facts_kept = ["_levels_a", "_levels_b", "_least_a", "_least_b", "_n_a"]
    expected = F.col("_row") * F.col("_column") / F.col("_n_a")
    summed = priced.groupBy(*group, *facts_kept).agg(
        F.sum(F.pow(F.col("_o") - expected, F.lit(2)) / expected).alias("_seen"),
        F.sum(expected).alias("_expected"),
        F.count(F.lit(1)).alias("_cells"),
    )
    grid = F.col("_levels_a") * F.col("_levels_b")
    unseen = F.when(F.col("_cells") < grid, F.col("_n_a") - F.col("_expected")).otherwise(0.0)
    chi2 = F.col("_seen") + unseen
    smaller = F.least("_levels_a", "_levels_b") - 1
    return summed.select(
        *group,
        chi2.alias("chi2"),
        ((F.col("_levels_a") - 1) * (F.col("_levels_b") - 1)).alias("dof"),
        F.col("_n_a").cast("long").alias("n"),
        (F.col("_least_a") * F.col("_least_b") / F.col("_n_a")).alias("expected_min"),
        F.sqrt(ratio(chi2, F.col("_n_a") * smaller)).alias("cramers_v"),
    )


def chi_square(df: DataFrame, a: str, b: str, by: Sequence[str] = (), alpha: float = ALPHA) -> DataFrame:
    """Chi-square test of independence of two columns, per segment.

    Without segments a table below 2 x 2 is an error; such a segment is left untested (NULL p).
    """
    stats = chi_square_statistics(df, a, b, by)
    if not by:
        row = stats.first()
        if row is None or row["dof"] == 0:
            raise AnalysisError(f"the table of {a} and {b} is smaller than 2 x 2")
        stats = df.sparkSession.createDataFrame([row], stats.schema)
    tested = stats.select("*", chi2_test(F.col("chi2"), F.col("dof")).alias("_test"))
    return tested.select(*stats.columns, *_verdict_columns(F.col("_test.p"), F.col("_test.log10_p"), alpha))
