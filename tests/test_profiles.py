"""Profiles against numpy, and the sliced plans against the plain ones."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcome_lens.contract import CENSUS, AnalysisError, Outcome
from outcome_lens.functions.formats import effect_label, p_text
from outcome_lens.functions.ordering import running_totals
from outcome_lens.functions.quantiles import quantiles
from outcome_lens.operators.describe import correlation, describe_all, describe_numeric, top_bottom
from outcome_lens.operators.distributions import box_stats, histogram, shape_profile
from outcome_lens.operators.levels import crosstab, level_counts, reference_levels
from outcome_lens.operators.rates import fold_rare, outcome_rate, rank_levels
from tests.conftest import by


@pytest.fixture(scope="module")
def numbers(spark):
    """Skewed, tied and missing values; one group holds most rows, one value a third of them."""
    rng = np.random.default_rng(3)
    x = np.round(rng.exponential(50, 6000), 2)
    x[rng.random(6000) < 0.33] = 7.0
    rows = [
        ("big" if i % 10 else "small", None if i % 97 == 0 else float(v), float("nan") if i % 89 == 0 else float(i % 13))
        for i, v in enumerate(x)
    ]
    return spark.createDataFrame(rows, "g string, x double, y double").cache()


def values(df, name, group=None):
    rows = df.collect()
    return np.array([r[name] for r in rows if r[name] is not None and not math.isnan(r[name]) and group in (None, r["g"])])


@pytest.mark.parametrize("by_group", [[], ["g"]])
def test_selected_quantiles_equal_the_sorted_ones(numbers, by_group):
    probs = [0.0, 0.25, 0.333, 0.5, 0.995, 1.0]
    found = quantiles(numbers, ["x", "y"], probs, by=by_group).collect()
    assert len(found) == len(probs) * 2 * (2 if by_group else 1)
    for r in found:
        want = np.quantile(values(numbers, r["column"], r["g"] if by_group else None), r["p"])
        assert r["value"] == pytest.approx(want, abs=1e-9)


def test_quantile_of_an_empty_column_is_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    found = {r["column"]: r["value"] for r in quantiles(df, ["a", "b"], [0.5]).collect()}
    assert found == {"a": None, "b": 1.5}


def test_approximate_quantiles_stay_near(numbers):
    found = quantiles(numbers, ["x"], [0.5, 0.9], exact=False).collect()
    for r in found:
        assert r["value"] == pytest.approx(np.quantile(values(numbers, "x"), r["p"]), rel=0.05)


@pytest.mark.parametrize("slices", [1, 7, 50])
def test_running_totals_do_not_depend_on_slices(spark, slices):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("o"), (F.col("id") % 7).alias("v"))
    settings = {"spark.sql.shuffle.partitions": str(slices), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        done = running_totals(df, ["g"], [F.col("o").desc()], {"t": F.col("v"), "n": F.lit(1)})
        assert done.select("g", "o").count() == 500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plain = W.partitionBy("g").orderBy(F.col("o").desc()).rowsBetween(W.unboundedPreceding, 0)
    want = df.select("*", F.sum("v").over(plain).alias("t"), F.sum(F.lit(1)).over(plain).alias("n"))
    assert sorted(map(tuple, done.collect())) == sorted(map(tuple, want.collect()))


def test_running_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", i) for i in range(20)], "g string, o int")
    done = running_totals(df, ["g"], [F.col("o").asc()], {"n": F.lit(1)})
    assert sorted(r["n"] for r in done.filter("g is null").collect()) == list(range(1, 21))


def test_describe_matches_numpy(numbers):
    row = by(describe_numeric(numbers, ["x"]), "column")["x"]
    x = values(numbers, "x")
    assert row["count"] == len(x) and row["mean"] == pytest.approx(x.mean()) and row["std"] == pytest.approx(x.std(ddof=1))
    assert (row["min"], row["max"]) == (x.min(), x.max())
    assert [row[q] for q in ("q25", "q50", "q75")] == pytest.approx(list(np.quantile(x, [0.25, 0.5, 0.75])))


def test_describe_all_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("a", None)], "s string, n int")
    found = by(describe_all(df), "column")
    assert tuple(found["s"])[1:] == (4, 2, "a", 2)
    assert tuple(found["n"])[1:] == (4, None, None, None)


def test_correlation_is_pairwise_and_null_for_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 7.9, 5.0)], "a double, b double, c double")
    found = {(r["a"], r["b"]): r for r in correlation(df).collect()}
    assert len(found) == 9
    assert found["a", "b"]["r"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 7.9])[0, 1]) and found["b", "a"]["n"] == 3
    assert found["a", "c"]["r"] is None
    assert {(r["a"], r["b"]) for r in correlation(df, triangle="lower").collect()} == {("b", "a"), ("c", "a"), ("c", "b")}
    with pytest.raises(AnalysisError):
        correlation(df, ["a"], triangle="lower")


def test_top_and_bottom(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(8)], "k int, v double")
    found = [(r["end"], r["place"], r["k"]) for r in top_bottom(df, "v", 3, ["k"]).collect()]
    assert sorted(found) == [("bottom", 1, 0), ("bottom", 2, 4), ("bottom", 3, 1), ("top", 1, 3), ("top", 2, 7), ("top", 3, 2)]


def test_rates_sort_order_and_overall(people, drawn):
    rates = outcome_rate(people, ["education", "sex"], CENSUS.outcome, order_by="education-num")
    found = {(r["column"], r["level"]): r for r in rates.collect()}
    high = drawn["income"] == ">50K"
    for column in ("education", "sex"):
        for level, share in high.groupby(drawn[column]).mean().items():
            assert found[column, level]["ratio"] == pytest.approx(share)
    assert found["education", "Assoc-voc"]["position"] == 11.0
    assert found[None, None]["ratio"] == pytest.approx(high.mean()) and found[None, None]["n"] == len(drawn)
    ranks = {(r["column"], r["level"]): r["rank"] for r in rank_levels(rates).collect()}
    order = sorted(drawn["education"].unique(), key=lambda level: (found["education", level]["ratio"], level))
    assert [ranks["education", level] for level in order] == [1, 2, 3, 4]


def test_missing_levels_count_in_the_overall_rate_only(spark):
    df = spark.createDataFrame([("a", "y"), (None, "y"), ("a", "n"), (None, "n"), (None, "n")], "s string, o string")
    found = {r["kind"]: r for r in outcome_rate(df, ["s"], Outcome("o", "y")).collect()}
    assert found["level"]["n"] == 2 and found["overall"]["n"] == 5 and found["overall"]["positives"] == 2


def test_folding_keeps_every_row(spark):
    df = spark.createDataFrame(
        [(f"l{i:02d}", "y" if j == 0 else "n", "only") for i in range(25) for j in range(i + 1)], "s string, o string, t string"
    )
    rates = outcome_rate(df, ["s", "t"], Outcome("o", "y"))
    found = by(fold_rare(rates).filter("column = 's'"), "level")
    assert len(found) == 15 and sum(r["n"] for r in found.values()) == df.count()
    assert found["other 11"]["folded"] == 11 and found["other 11"]["n"] == sum(range(1, 12))
    assert found["other 11"]["ratio"] == pytest.approx(11 / 66)
    assert fold_rare(rates).filter("column = 't'").count() == 1
    # 20 levels are not folded
    few = outcome_rate(df.filter("s < 'l20'"), ["s"], Outcome("o", "y"))
    assert fold_rare(few).count() == 20


def test_crosstab_lists_empty_cells(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("b", "y")] * 2 + [("b", None)], "p string, q string")
    found = {(r["a"], r["b"]): (r["observed"], r["expected"]) for r in crosstab(df, "p", "q").collect()}
    assert found == {("a", "x"): (3, 1.8), ("a", "y"): (0, 1.2), ("b", "x"): (0, 1.2), ("b", "y"): (2, 0.8)}


def test_reference_is_the_commonest_then_the_first_by_name(spark):
    df = spark.createDataFrame([("United-States",)] * 50 + [("Cambodia",)] * 2, "c string")
    assert reference_levels(df, ["c"]).first()["level"] == "United-States"
    tied = spark.createDataFrame([("Male",), ("Female",)] * 10, "c string")
    assert reference_levels(tied, ["c"]).first()["level"] == "Female"
    assert {r["level"]: r["n"] for r in level_counts(tied, ["c"]).collect()} == {"Male": 10, "Female": 10}


def test_histogram_equals_numpy_and_has_area_one(numbers):
    x = values(numbers, "x")
    edges = np.histogram_bin_edges(x, 36)
    rows = histogram(numbers, "x", "g").collect()
    assert len(rows) == 72
    for g in ("big", "small"):
        mine = sorted((r for r in rows if r["group"] == g), key=lambda r: r["bin"])
        assert [r["n"] for r in mine] == list(np.histogram(values(numbers, "x", g), edges)[0])
        assert sum(r["density"] * (r["hi"] - r["lo"]) for r in mine) == pytest.approx(1.0)


def test_histogram_scales(spark, numbers):
    positive = values(numbers, "x")
    positive = np.log10(positive[positive > 0])
    rows = histogram(numbers, "x", "g", bins=10, scale="log10").collect()
    assert sum(r["n"] for r in rows) == len(positive)
    assert max(r["hi"] for r in rows) == pytest.approx(10 ** positive.max())
    whole = histogram(numbers, "y", "g", scale="discrete").collect()
    assert {r["bin"] for r in whole} == set(range(13)) and min(r["lo"] for r in whole) == -0.5
    one = spark.createDataFrame([("a", 3.0)] * 4, "g string, x double")
    assert sum(r["n"] for r in histogram(one, "x", "g").collect()) == 4
    with pytest.raises(AnalysisError):
        histogram(one.limit(0), "x", "g")


def test_box_ends_at_values_inside_the_fences(numbers):
    for r in box_stats(numbers, "x", "g").collect():
        x = values(numbers, "x", r["group"])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, q2, q3])
        assert (r["whisker_low"], r["whisker_high"]) == (inside.min(), inside.max())
        assert r["n"] == len(x) and r["mean"] == pytest.approx(x.mean())


def test_shapes(spark):
    rows = [(0.0 if i % 3 else float(i), float(i % 20), float(i % 21), 1000.0 if i == 5 else float(i % 50)) for i in range(600)]
    df = spark.createDataFrame(rows, "mostly_zero double, twenty double, more double, outlier double")
    found = by(shape_profile(df, df.columns), "column")
    assert found["mostly_zero"]["skewed"] and not found["mostly_zero"]["clipped"]
    assert found["twenty"]["discrete"] and found["twenty"]["distinct_values"] == 20
    assert not found["more"]["discrete"] and found["more"]["distinct_values"] is None
    assert found["outlier"]["clipped"] and not found["more"]["clipped"]


def test_text_of_p_and_effect(spark):
    df = spark.createDataFrame([(0.0, 0.1), (1.232e-309, -0.3), (3.2e-5, 0.79), (1e-4, -0.8), (0.25, None)], "p double, d double")
    found = [tuple(r) for r in df.select(p_text(F.col("p")), effect_label(F.col("d"))).collect()]
    assert found == [
        ("below 1e-308", "very small"), ("1.232e-309", "small"), ("3.200e-05", "medium"), ("0.000100", "large"), ("0.250000", None),
    ]


@settings(max_examples=8, deadline=None)
@given(data=st.lists(st.tuples(st.sampled_from("ab"), st.integers(-3, 3)), min_size=1, max_size=30))
def test_quantiles_of_any_small_table(spark, data):
    df = spark.createDataFrame(data, "g string, x int")
    for r in quantiles(df, ["x"], [0.1, 0.5], by=["g"]).collect():
        assert r["value"] == pytest.approx(np.quantile([x for g, x in data if g == r["g"]], r["p"]))
