"""Comparison, missing cells, cleaning, split checks; each detector must see a planted fault."""

import pytest
from pyspark.sql import functions as F

from outcome_lens.contract import CENSUS, AnalysisError
from outcome_lens.operators import splits
from outcome_lens.operators.caveats import level_purity, topcode_profile
from outcome_lens.operators.compare import compare_frames, compare_multisets, comparison_summary, differing_buckets
from outcome_lens.operators.quality import (
    clean,
    cleaning_summary,
    dedup,
    funnel,
    missingness_impact,
    null_profile,
)
from outcome_lens.operators.splits import split_overlap, unseen_levels
from tests.conftest import by

INCOME = CENSUS.outcome
SCHEMA = "age long, workclass string, income string"


def test_a_changed_cell_is_found(people, drawn):
    broken = people.withColumn("workclass", F.upper("workclass"))
    diff = by(compare_frames(people, broken, ["fnlwgt", "income"]), "column")
    assert diff["workclass"]["value_mismatch"] == len(drawn)
    assert all(r["value_mismatch"] == 0 for c, r in diff.items() if c != "workclass")
    row = comparison_summary(people, broken, ["fnlwgt", "income"]).first()
    assert not row["identical"] and row["value_mismatch"] == len(drawn)


def test_nan_and_null_are_one_missing_state(spark):
    left = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, x double")
    right = spark.createDataFrame([(1, None), (2, None), (3, float("nan"))], "k int, x double")
    row = compare_frames(left, right, ["k"]).first()
    assert (row["null_mismatch"], row["value_mismatch"]) == (1, 0)


def test_different_shape_leaves_cell_counts_undefined(spark):
    left, right = spark.range(3).withColumn("x", F.lit(1)), spark.range(2).withColumn("x", F.lit(1))
    row = comparison_summary(left, right, ["id"]).first()
    assert not row["identical"] and row["null_mismatch"] is None and row["missing_keys"] == 1
    other = comparison_summary(left, left.withColumnRenamed("x", "y"), ["id"]).first()
    assert not other["columns_match"] and not other["identical"]


def test_repeated_keys_do_not_multiply(spark):
    many = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("x"))
    row = comparison_summary(many, many, ["k"]).first()
    assert row["duplicate_keys"] == 1 and row["left_rows"] == 1000 and not row["identical"]


def test_number_against_text_is_a_type_and_value_mismatch(spark):
    left, right = spark.createDataFrame([(1, 5)], "k int, x int"), spark.createDataFrame([(1, "5")], "k int, x string")
    row = compare_frames(left, right, ["k"]).first()
    assert row["type_mismatch"] and row["value_mismatch"] == 1


def test_multisets_count_copies_and_match_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, s string")
    right = spark.createDataFrame([(1, None), (2, "a"), (2, "b")], "k int, s string")
    found = {(r["k"], r["s"]): (r["left_copies"], r["right_copies"]) for r in compare_multisets(left, right).collect()}
    assert found == {(1, None): (2, 1), (2, "b"): (0, 1)}
    with pytest.raises(AnalysisError):
        compare_multisets(left, right.select("s", "k"))


def test_funnel_drops_missing_then_duplicates(spark):
    df = spark.createDataFrame(
        [(39, "Private", "<=50K"), (39, "Private", "<=50K"), (50, "Private", ">50K"), (31, None, "<=50K")], SCHEMA
    )
    row = funnel(df).first()
    assert (row["raw"], row["complete"], row["clean"]) == (4, 3, 2)
    assert clean(df).count() == 2
    assert [tuple(r) for r in null_profile(df).collect()] == [("workclass", 1, 4)]


def test_drop_rates_per_group(spark):
    df = spark.createDataFrame(
        [(39, None, "<=50K"), (40, "Private", "<=50K"), (50, "Private", ">50K"), (31, None, "<=50K"), (20, None, None)],
        SCHEMA,
    )
    found = {r["group"]: r for r in missingness_impact(df.limit(4), INCOME).collect()}
    assert found["<=50K"]["drop_rate"] == pytest.approx(2 / 3) and found[">50K"]["drop_rate"] == 0.0
    assert found["<=50K"]["removed"] == 2 and found[">50K"]["removed"] == 0
    assert found[None]["rate_before"] == pytest.approx(0.25) and found[None]["rate_after"] == pytest.approx(0.5)
    # a row without a label is in no group, but counts among all rows
    found = {r["group"]: r for r in missingness_impact(df, INCOME).collect()}
    assert set(found) == {"<=50K", ">50K", None} and found[None]["total"] == 5


def test_nothing_kept_has_no_rate(spark):
    df = spark.createDataFrame([(1, None, "<=50K")], SCHEMA)
    overall = missingness_impact(df, INCOME).filter("kind = 'overall'").first()
    assert overall["rate_after"] is None and overall["drop_rate"] == 1.0


def test_unknown_strategy_keeps_rows(spark):
    df = spark.createDataFrame([(1, None, "<=50K"), (2, "Private", ">50K"), (None, None, ">50K")], SCHEMA)
    kept = clean(df, "unknown", ["workclass"])
    assert sorted(r["workclass"] for r in kept.collect()) == ["Private", "Unknown"]
    row = funnel(df, "unknown", ["workclass"]).first()
    assert (row["raw"], row["complete"], row["clean"]) == (3, 2, 2)
    with pytest.raises(AnalysisError):
        clean(df, "guess")


def test_dedup_treats_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, s string")
    assert dedup(df).count() == 2
    assert dedup(df, ["k"]).columns == ["k"]


def test_summary_holds_all_stages(people, drawn):
    found = {(r["split"], r["measure"], r["item"]): r["value"] for r in cleaning_summary({"a": people}, INCOME).collect()}
    high = (drawn["income"] == ">50K").sum()
    assert found["a", "rows", "raw"] == found["a", "rows", "clean"] == len(drawn)
    assert found["a", "total", ">50K"] == high and found["a", "rate_before", ""] == pytest.approx(high / len(drawn))


def test_overlap_counts_pairs_rows_and_nulls(spark):
    train = spark.createDataFrame([(1, None)] * 3 + [(2, "a")], "k int, s string")
    test = spark.createDataFrame([(1, None)] * 2 + [(3, "a")], "k int, s string")
    row = split_overlap(train, test).first()
    assert (int(row["pair_rows"]), row["distinct_rows"], row["test_rows_hit"]) == (6, 1, 2)
    assert int(split_overlap(train, test.limit(0)).first()["pair_rows"]) == 0


def test_overlap_of_a_hot_row_does_not_overflow(spark):
    hot = spark.range(20000).select(F.lit("x").alias("s"))
    row = split_overlap(hot, hot).first()
    assert int(row["pair_rows"]) == 20000**2 and row["distinct_rows"] == 1


def test_all_rows_overlap_with_themselves(people, drawn):
    row = split_overlap(people, people).first()
    assert row["test_rows_hit"] == len(drawn)


def test_unseen_rows_are_counted_once(people):
    names = CENSUS.categorical
    changed = people.withColumn(
        "workclass", F.when(F.col("fnlwgt") < 7_013 + 37 * 5, "Never-seen").otherwise(F.col("workclass"))
    ).withColumn("occupation", F.when(F.col("fnlwgt") >= 7_013 + 37 * 81, "New").otherwise(F.col("occupation")))
    found = {r["column"]: r["unseen_rows"] for r in unseen_levels(people, changed, names).collect()}
    assert found[None] == 8 and found["workclass"] == 5 and found["occupation"] == 3 and found["race"] == 0
    assert {r["unseen_rows"] for r in unseen_levels(people, people, names).collect()} == {0}


def test_missing_level_in_test_is_seen_if_training_has_one(spark):
    with_null = spark.createDataFrame([("a",), (None,)], "s string")
    without = spark.createDataFrame([("a",)], "s string")
    assert {r["unseen_rows"] for r in unseen_levels(with_null, with_null, ["s"]).collect()} == {0}
    assert {r["unseen_rows"] for r in unseen_levels(without, with_null, ["s"]).collect()} == {1}


def test_topcode_and_purity(spark, people, drawn):
    capped = drawn["fnlwgt"] % 5 == 0
    gains = people.withColumn("capital-gain", F.when(F.col("fnlwgt") % 5 == 0, 99999).otherwise(F.col("capital-gain")))
    row = topcode_profile(gains, "capital-gain", 99999, INCOME).first()
    assert row["capped_rows"] == capped.sum()
    assert row["capped_positive_rate"] == pytest.approx((drawn["income"] == ">50K")[capped].mean())
    assert row["zero_share"] == pytest.approx(((drawn["capital-gain"] == 0) & ~capped).mean())
    assert topcode_profile(people, "age", 99, INCOME).first()["capped_positive_rate"] == 0.0
    roles = spark.createDataFrame([("Male", "Husband")] * 5 + [("Female", "Wife")] * 4 + [("Male", "Wife")], "sex string, role string")
    found = by(level_purity(roles, "sex", "role", ["Husband", "Wife", "Absent"]), "level")
    assert set(found) == {"Husband", "Wife"}
    assert found["Husband"]["share"] == 1.0 and found["Wife"]["share"] == 0.8 and found["Wife"]["dominant"] == "Female"


def test_only_buckets_that_differ_are_compared(spark):
    rows = [(i, i % 3, float(i) if i % 5 else None, None if i % 4 else "t") for i in range(2000)]
    left = spark.createDataFrame(rows, "k long, a int, b double, c string")
    right = left.select(F.col("k").cast("int").alias("k"), F.col("a").cast("long").alias("a"), F.when(F.col("b").isNull(), float("nan")).otherwise(F.col("b")).alias("b"), "c")
    names = ["a", "b", "c"]
    assert differing_buckets(left, right, ["k"], names).count() == 0
    assert not any(r.null_mismatch or r.value_mismatch for r in compare_frames(left, right, ["k"]).collect())
    # a cell that changes place with a missing one, a changed cell, and a row less
    moved = right.withColumn("c", F.when(F.col("k") == 8, F.lit(None)).otherwise(F.col("c"))).withColumn("a", F.when(F.col("k") == 9, 7).otherwise(F.col("a"))).filter("k <> 10")
    assert differing_buckets(left, moved, ["k"], names).count() == 3
    found = {r.column: (r.null_mismatch, r.value_mismatch) for r in compare_frames(left, moved, ["k"]).collect()}
    assert found == {"a": (0, 1), "b": (0, 0), "c": (1, 0)}


@pytest.mark.parametrize("turned", [False, True])
def test_a_small_split_cuts_the_large_one_before_the_shuffle(spark, turned):
    large = spark.range(20_000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    small = large.filter("a < 30 or (a is null and b = '0')").select(F.col("a").cast("int").alias("a"), "b")
    train, test = (small, large) if turned else (large, small)
    cut = splits._only_shared(train, test, ["a", "b"])[1 if turned else 0]
    assert cut.count() < 1000
    want = train.groupBy("a", "b").count().withColumnRenamed("count", "n").alias("x").join(
        test.groupBy("a", "b").count().withColumnRenamed("count", "m").alias("y"), F.expr("x.a <=> y.a and x.b <=> y.b")
    )
    want = want.agg(F.sum(F.expr("n * m")).alias("pairs"), F.count("*").alias("rows"), F.sum("m").alias("hit")).first()
    got = split_overlap(train, test).first()
    assert (int(got.pair_rows), got.distinct_rows, got.test_rows_hit) == (want.pairs, want.rows, want.hit)
