"""Hypothesis tests: published values, closed forms, degenerate input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError
from outcome_lens.functions import tails
from outcome_lens.operators.hypothesis import chi_square, chi_square_statistics, welch_statistics, welch_t


def counts(spark, table: dict):
    rows = [(a, b, n) for (a, b), n in table.items()]
    return spark.createDataFrame(rows, "a string, b string, n int").select("a", "b", F.explode(F.sequence(F.lit(1), "n"))).drop("col")


def test_published_sex_income_table(spark):
    df = counts(spark, {("Female", "<=50K"): 8661, ("Female", ">50K"): 1112, ("Male", "<=50K"): 13972, ("Male", ">50K"): 6394})
    row = chi_square(df, "a", "b").first()
    assert row["chi2"] == pytest.approx(1414.873, abs=5e-4) and row["dof"] == 1 and row["n"] == 30139
    assert row["p_text"] == "1.232e-309" and row["significant"] and not row["p_underflow"]
    assert row["cramers_v"] == pytest.approx(0.217, abs=5e-4) and row["expected_min"] == pytest.approx(2434, abs=0.5)


def test_drawn_proportional_and_degenerate_tables(spark):
    drawn = np.random.default_rng(8).integers(3, 70, (3, 2))
    row = chi_square(counts(spark, {(str(i), str(j)): int(n) for (i, j), n in np.ndenumerate(drawn)}), "a", "b").first()
    expected = drawn.sum(1, keepdims=True) * drawn.sum(0) / drawn.sum()
    assert row["chi2"] == pytest.approx(((drawn - expected) ** 2 / expected).sum()) and row["dof"] == 2
    assert row["cramers_v"] == pytest.approx(math.sqrt(row["chi2"] / drawn.sum()))
    even = chi_square(counts(spark, {("p", "u"): 6, ("p", "v"): 9, ("q", "u"): 14, ("q", "v"): 21}), "a", "b").first()
    assert even["chi2"] == pytest.approx(0, abs=1e-12) and even["cramers_v"] == pytest.approx(0, abs=1e-6) and not even["significant"]
    with pytest.raises(AnalysisError):
        chi_square(counts(spark, {("only", "one"): 7}), "a", "b")
    with pytest.raises(AnalysisError):
        chi_square(counts(spark, {("only", "one"): 7}).limit(0), "a", "b")


def test_empty_cells_add_their_expected_count(spark):
    table = {("a", "x"): 10, ("a", "y"): 5, ("b", "x"): 7, ("c", "y"): 9}
    row = chi_square_statistics(counts(spark, table), "a", "b").first()
    n, chi2, least = sum(table.values()), 0.0, math.inf
    for a in "abc":
        for b in "xy":
            e = sum(v for k, v in table.items() if k[0] == a) * sum(v for k, v in table.items() if k[1] == b) / n
            chi2 += (table.get((a, b), 0) - e) ** 2 / e
            least = min(least, e)
    assert row["chi2"] == pytest.approx(chi2) and row["expected_min"] == pytest.approx(least) and row["dof"] == 2


def test_segments_equal_separate_tests(spark):
    df = counts(spark, {("a", "x"): 30, ("a", "y"): 10, ("b", "x"): 15, ("b", "y"): 25}).withColumn("s", F.lit("one"))
    both = df.unionByName(df.limit(40).withColumn("s", F.lit("two")))
    found = {r["s"]: r for r in chi_square(both, "a", "b", by=["s"]).collect()}
    alone = chi_square(df, "a", "b").first()
    assert found["one"]["chi2"] == pytest.approx(alone["chi2"]) and found["one"]["p"] == pytest.approx(alone["p"])


def test_welch_against_hand_computation(spark):
    a, b = [50.0, 51.0, 52.0, 53.0, 54.0, 60.0], [35.0, 36.0, 37.0, 38.0, 39.0]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b] + [("b", None), ("c", 1.0)], "g string, x double")
    row = welch_t(df, "x", "g", "a", "b").first()
    mean = lambda v: sum(v) / len(v)
    var = lambda v: sum((i - mean(v)) ** 2 for i in v) / (len(v) - 1)
    se = math.sqrt(var(a) / 6 + var(b) / 5)
    dof = se**4 / ((var(a) / 6) ** 2 / 5 + (var(b) / 5) ** 2 / 4)
    assert (row["n_a"], row["n_b"]) == (6, 5)
    assert row["t"] == pytest.approx((mean(a) - mean(b)) / se) and row["dof"] == pytest.approx(dof)
    assert row["cohens_d"] == pytest.approx((mean(a) - mean(b)) / math.sqrt((5 * var(a) + 4 * var(b)) / 9))
    assert row["effect"] == "large" and row["significant"] and row["ci_low"] < row["diff"] < row["ci_high"]
    assert row["ci_high"] - row["ci_low"] == pytest.approx(2 * se * tails.t_quantile_upper(0.025, dof))


def test_welch_edge_cases(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0), ("c", 2.0)], "g string, x double")
    flat = welch_statistics(df, "x", "g", "a", "b").first()
    assert flat["cohens_d"] == 0.0 and flat["t"] is None
    single = welch_t(df, "x", "g", "a", "c").first()
    assert single["cohens_d"] is None and single["p"] is None and single["effect"] is None
    with pytest.raises(AnalysisError, match="empty group"):
        welch_t(df, "x", "g", "a", "nobody")


def test_a_difference_too_clear_for_a_double_keeps_its_logarithm(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 2 * 1000 + F.col("id") % 7).cast("double").alias("x"))
    row = welch_t(df, "x", "g", "a", "b").first()
    assert row["p"] == 0.0 and row["p_underflow"] and row["p_text"] == "below 1e-308" and row["log10_p"] < -308
    assert row["significant"]


def test_tails_against_known_values():
    assert math.exp(tails.log_chi2_tail(3.841458820694124, 1)) == pytest.approx(0.05, rel=1e-12)
    assert math.exp(tails.log_chi2_tail(21.02606981748307, 12)) == pytest.approx(0.05, rel=1e-10)
    for k in (2, 8, 20):  # closed form for an even dof
        for x in (0.1, 3.0, 40.0, 300.0):
            want = -x / 2 + math.log(sum((x / 2) ** i / math.factorial(i) for i in range(k // 2)))
            assert tails.log_chi2_tail(x, k) == pytest.approx(want, rel=1e-10, abs=1e-13)
    for t in (0.0, 0.3, 2.0, 50.0):  # dof 1 and 2 have closed forms
        assert math.exp(tails.log_t_two_sided(t, 1)) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert math.exp(tails.log_t_two_sided(t, 2)) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    assert tails.t_quantile_upper(0.025, 10) == pytest.approx(2.228138851986, rel=1e-10)
    for dof in (9e6, 1.1e7, 1e12):
        assert tails.log_t_two_sided(2.0, dof) == pytest.approx(math.log(math.erfc(2 / math.sqrt(2))), rel=1e-6)
        assert tails.t_quantile_upper(0.025, dof) == pytest.approx(1.959963985, rel=1e-6)
    assert tails.log_chi2_tail(2000, 1) == pytest.approx(-1000 - 0.5 * math.log(math.pi * 1000), rel=1e-5)


@pytest.mark.parametrize("dof", [1e4, 3e4, 1e6, 1e8, 1e9, 4e9, 1e13])
def test_chi_square_tail_at_high_dof(dof):
    """At the mean the tail is just below one half; far out it follows the cube-root normal approximation."""
    third = math.sqrt(2 / (9 * dof))  # the median is near dof (1 - 2 / 9 dof)^3
    at_mean = math.exp(tails.log_chi2_tail(dof, dof))
    assert 0.5 - 0.6 * third < at_mean < 0.5
    assert math.exp(tails.log_chi2_tail(dof * (1 - 2 / (9 * dof)) ** 3, dof)) == pytest.approx(0.5, abs=1e-5)
    for z in (-3.0, 1.0, 4.0):
        x = dof * (1 - 2 / (9 * dof) + z * third) ** 3
        assert math.exp(tails.log_chi2_tail(x, dof)) == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=2e-3)


def test_chi_square_tail_is_smooth_where_the_method_changes():
    for x in (18_000.0, 19_990.0, 20_000.0, 20_300.0, 24_000.0):
        below, above = (tails.log_chi2_tail(x, d) for d in (2 * tails.LARGE, 2 * tails.LARGE + 1e-6))
        assert below == pytest.approx(above, rel=1e-7, abs=1e-12)
