"""The physical plans: pruned scans, no nested loops, no re-read of the table, bounded broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, Outcome
from outcome_lens.functions.sizes import settled
from outcome_lens.operators.compare import compare_frames, compare_multisets
from outcome_lens.operators.design import fit_fold_designs, model_rows
from outcome_lens.operators.distributions import box_stats, histogram
from outcome_lens.operators.hypothesis import chi_square_statistics, welch_statistics
from outcome_lens.operators.levels import level_counts, reference_levels
from outcome_lens.operators.logistic import solve
from outcome_lens.operators.quality import funnel, missingness_impact
from outcome_lens.operators.rates import outcome_rate
from outcome_lens.operators.splits import split_overlap
from outcome_lens.session import CLUSTER_SETTINGS

OUTCOME = Outcome("o", "y")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "table")
    spark.range(5000).select(
        "id",
        (F.col("id") % 7).cast("string").alias("a"),
        (F.col("id") % 5).cast("string").alias("b"),
        F.when(F.col("id") % 3 == 0, "y").otherwise("n").alias("o"),
        F.when(F.col("id") % 11 != 0, F.sqrt("id")).alias("x"),
        F.repeat(F.lit("wide"), 100).alias("unused"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df) -> str:
    """The plan as it was run, with exchanges that were reused left out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


CASES = {
    "rates": (lambda t: outcome_rate(t, ["a", "b"], OUTCOME), 1),
    "levels": (lambda t: level_counts(t, ["a", "b"]), 1),
    "references": (lambda t: reference_levels(t, ["a", "b"]), 1),
    "histogram": (lambda t: histogram(t, "x", "a"), 1),
    "box": (lambda t: box_stats(t, "x", "a"), 1),
    "chi by segment": (lambda t: chi_square_statistics(t, "a", "o", by=["b"]), 1),
    "welch by segment": (lambda t: welch_statistics(t, "x", "o", "y", "n", by=["a"]), 1),
    "missingness": (lambda t: missingness_impact(t.select("a", "x", "o"), OUTCOME), 1),
    "funnel": (lambda t: funnel(t.select("a", "x")), 1),
    "multisets": (lambda t: compare_multisets(t.select("a", "x"), t.select("a", "x")), 2),
    "frames": (lambda t: compare_frames(t.select("id", "a", "x"), t.select("id", "a", "x"), ["id"]), 2),
    "overlap": (lambda t: split_overlap(t.select("a", "b"), t.select("a", "b")), 2),
}


@pytest.mark.parametrize("case", CASES)
def test_scans_are_pruned_and_not_repeated(table, case):
    run, scans = CASES[case]
    plan = final_plan(run(table))
    assert plan.count("FileScan") <= scans, plan
    assert "unused" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("case", ["rates", "levels", "welch by segment", "overlap", "funnel"])
def test_rows_are_combined_before_the_first_shuffle(table, case):
    plan = final_plan(CASES[case][0](table))
    below_first_exchange = plan[plan.rindex("Exchange hashpartitioning") :]
    assert re.search(r"HashAggregate\(.*(partial_|functions=\[\])", below_first_exchange), below_first_exchange


def test_filters_reach_the_scan(table):
    plan = final_plan(outcome_rate(table.filter("id > 4000"), ["a"], OUTCOME))
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,4000)]" in plan


def test_only_small_results_are_settled(spark):
    assert settled(spark.range(50)).count() == 50
    with pytest.raises(AnalysisError):
        settled(spark.range(5000))


def test_a_fold_never_meets_a_solver_in_one_task(spark):
    """A fold that holds nearly all rows, none of them alike, leaves the rows in many partitions."""
    rows = spark.range(4000, numPartitions=8).select(
        F.rand(1).alias("x"), F.when(F.rand(2) < 0.5, "y").otherwise("n").alias("label"), (F.col("id") % 20 > 18).cast("int").alias("fold")
    )
    designs = fit_fold_designs(rows, ["x"], [], Outcome("label", "y"), "fold", 2)
    for i, design in enumerate(designs):
        part = model_rows(rows, designs[0], keep=["fold"]).filter(F.col("fold") != i)
        assert part.rdd.getNumPartitions() == 8
        assert solve(design, part).design is design


def test_an_unset_cluster_session_starts_wide():
    assert int(CLUSTER_SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 2000
