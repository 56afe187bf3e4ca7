"""Models over many levels, sums in trees, profiles, and folds fitted together."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, Outcome
from outcome_lens.functions.blocks import BLOCK, packed, tree_sum
from outcome_lens.functions.profiles import SKETCH_SIZE, exact_quantiles, profile, select_ranges, sketched
from outcome_lens.operators.design import fit_encoder
from outcome_lens.operators.distributions import box_stats, histogram, shape_profile
from outcome_lens.operators.logistic import coefficient_stats, fit_folds, fit_logistic, out_of_fold, score
from outcome_lens.operators.wide import MOST_ASKED, fit_wide, wide_coefficient_stats, wide_coefficients, wide_score

BOUGHT = Outcome("bought", "y")


@pytest.fixture(scope="module")
def buyers(spark):
    rng = np.random.default_rng(5)
    n = 1500
    age = rng.normal(40, 9, n).round(1)
    shop = rng.zipf(1.6, n).clip(1, 200)
    kind = rng.choice(["a", "b", "c.d"], n, p=[0.2, 0.7, 0.1])
    eta = 0.06 * (age - 40) + 0.8 * np.sin(shop) - 0.6 * (kind == "a")
    bought = np.where(rng.random(n) < 1 / (1 + np.exp(-eta)), "y", "n")
    rows = [(i, float(a), int(s), str(k), str(b)) for i, (a, s, k, b) in enumerate(zip(age, shop, kind, bought, strict=True))]
    return spark.createDataFrame(rows, "id long, age double, `the shop` long, kind string, bought string").cache()


@pytest.fixture(scope="module")
def both(buyers):
    """The same model in both forms."""
    return fit_wide(buyers, ["age"], ["the shop", "kind"], BOUGHT), fit_logistic(buyers, ["age"], ["the shop", "kind"], BOUGHT)


def test_wide_coefficients_are_those_of_the_narrow_model(both):
    wide, narrow = both
    want = dict(zip(narrow.design.features, narrow.coefficients, strict=True))
    got = {(r.feature, r.level): r.coef for r in wide_coefficients(wide).collect()}
    assert set(got) == set(want) and wide.intercept == pytest.approx(narrow.intercept, abs=1e-4)
    assert [got[k] for k in want] == pytest.approx(list(want.values()), abs=1e-4)


def test_wide_errors_are_those_of_the_narrow_model(buyers, both):
    wide, narrow = both
    want = {(r.feature, r.level): r for r in coefficient_stats(narrow, buyers).collect()}
    asked = [("age", None), ("kind", "a"), ("the shop", "2"), ("the shop", "3")]
    for r in wide_coefficient_stats(wide, asked).collect():
        assert (r.se, r.or_low, r.or_high) == pytest.approx([want[r.feature, r.level][c] for c in ("se", "or_low", "or_high")], rel=1e-3)
    with pytest.raises(AnalysisError, match="no model columns"):
        wide_coefficient_stats(wide, [("the shop", "no such shop")])
    with pytest.raises(AnalysisError, match="at most"):
        wide_coefficient_stats(wide, [("age", None)] * (MOST_ASKED + 1))


def test_wide_scores_of_unseen_and_missing_levels(spark, buyers, both):
    wide, narrow = both
    some = spark.createDataFrame([(1, 33.0, 2, "a", "y"), (2, 33.0, 999, "never", "n"), (3, 33.0, None, None, "n")], buyers.schema)
    got, want = ([r.score for r in df.orderBy("id").collect()] for df in (wide_score(wide, some), score(narrow.model, some, BOUGHT)))
    assert got == pytest.approx(want, abs=1e-4)
    assert wide_score(wide, buyers).columns == [*buyers.columns, "score", "label", "predicted"]
    with pytest.raises(AnalysisError, match="rename"):
        wide_score(wide, buyers.withColumn("Score", F.lit(1)))


def test_wide_fits_refuse_what_cannot_be_fitted(buyers):
    with pytest.raises(AnalysisError, match="one class"):
        fit_wide(buyers.filter("bought = 'y'"), ["age"], ["kind"], BOUGHT)
    with pytest.raises(AnalysisError, match="has no value"):
        fit_wide(buyers.withColumn("age", F.lit(None).cast("double")), ["age"], ["kind"], BOUGHT)


def test_an_encoder_of_more_levels_than_a_matrix_may_have(spark):
    table = spark.range(9000).select((F.col("id") % 4500).cast("string").alias("c"), F.lit("x").alias("d"))
    rows = fit_encoder(table.unionByName(table.filter("c = '7'")), ["c", "d"])
    slots = [r.slot for r in rows.filter("column = 'c'").collect()]
    assert sorted(slots) == list(range(4500))
    assert rows.filter("is_reference").select("column", "level", "slot").orderBy("column").collect() == [("c", "7", 0), ("d", "x", 0)]
    assert fit_encoder(table.limit(0), ["c"]).count() == 0


@pytest.mark.parametrize("tasks", [1, 3, 70])
def test_blocks_are_summed_whatever_the_number_of_tasks(spark, tasks):
    def send(batches):
        total = np.zeros(3)
        for batch in batches:
            x = batch.column(0).to_numpy()
            total += [len(x), x.sum(), (x * x).sum()]
        yield packed(total)

    assert tree_sum(spark.range(1000, numPartitions=tasks).mapInArrow(send, BLOCK)).tolist() == [1000, 499500, 332833500]
    assert tree_sum(spark.createDataFrame([], BLOCK)) is None


def test_fold_models_are_those_fitted_alone(buyers):
    """Levels that only one fold has, and references that differ between folds, included."""
    marked = buyers.withColumn("kind", F.when(F.col("id") % 3 == 1, F.when(F.col("kind") == "b", "a").otherwise(F.col("kind"))).otherwise(F.col("kind")))
    marked = marked.withColumn("kind", F.when((F.col("id") % 3 == 2) & (F.col("id") < 90), "rare").otherwise(F.col("kind")))
    held = out_of_fold(marked, ["age"], ["kind", "the shop"], BOUGHT, F.col("id") % 3, k=3)
    assert held.columns == [*marked.columns, "fold", "score", "label", "predicted"]
    got = {r.id: r.score for r in held.collect()}
    for i in range(3):
        alone = fit_logistic(marked.filter(F.col("id") % 3 != i), ["age"], ["kind", "the shop"], BOUGHT, tol=1e-12)
        want = {r.id: r.score for r in score(alone.model, marked.filter(F.col("id") % 3 == i)).collect()}
        assert [got[k] for k in want] == pytest.approx(list(want.values()), abs=1e-4)


def test_a_step_reads_the_coded_rows_once(buyers, monkeypatch):
    """However many folds there are, a Newton step makes one sum, and scoring is one scan."""
    made = []
    monkeypatch.setattr("outcome_lens.operators.logistic.tree_sum", lambda blocks: made.append(1) or tree_sum(blocks))
    fit_folds(buyers.withColumn("fold", (F.col("id") % 5).cast("int")), ["age"], ["kind"], BOUGHT, 5)
    assert 3 <= len(made) <= 12


def test_scoring_all_folds_scans_once(spark, buyers, tmp_path):
    path = str(tmp_path / "buyers")
    buyers.write.parquet(path)
    held = out_of_fold(spark.read.parquet(path), ["age"], ["kind"], BOUGHT, F.col("id") % 4, k=4)
    held.collect()
    assert held._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# ---- profiles


@pytest.mark.parametrize("n", [1, 2, 3, 7, 150, 1111, 3 * SKETCH_SIZE])
def test_quantiles_from_two_scans_are_exact(spark, n):
    rng = np.random.default_rng(n)
    x, y = rng.normal(size=n), rng.integers(0, 5, n)
    df = spark.createDataFrame([(float(a), int(b), str(b % 2)) for a, b in zip(x, y, strict=True)], "x double, y int, g string")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.995, "e": 1.0}
    for r in exact_quantiles(df, profile(df, ["x", "y"]), probs).collect():
        assert [r[k] for k in probs] == pytest.approx(np.quantile({"x": x, "y": y}[r.column], list(probs.values())), abs=1e-12)
    for r in exact_quantiles(df, profile(df, ["x"], ["g"]), probs).collect():
        assert [r[k] for k in probs] == pytest.approx(np.quantile(x[(y % 2).astype(str) == r.g], list(probs.values())), abs=1e-12)


def test_columns_without_values_have_no_quantiles(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (2.0, None, None)], "x double, y double, z double")
    got = {r.column: r.m for r in exact_quantiles(df, profile(df, ["x", "y", "z"]), {"m": 0.5}).collect()}
    assert got == {"x": 1.5, "y": None, "z": None}


def test_a_rank_outside_its_range_is_an_error_and_no_value(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    known = profile(df, ["x"])
    selection = select_ranges(df, known, [F.struct(sketched(F.lit(0.1)).alias("lo"), sketched(F.lit(0.2)).alias("hi"))])
    wanted = known.rows.select("column", F.lit("k").alias("key"), F.lit(5000.0).alias("at"))
    with pytest.raises(Exception, match="outside the ranges"):
        selection.at(wanted).collect()


def test_profiles_and_boxes_read_the_table_twice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(5000).select(F.sqrt("id").alias("x"), (F.col("id") % 3).cast("string").alias("g")).write.parquet(path)
    table = spark.read.parquet(path)
    scans = []
    from outcome_lens.functions import profiles

    real = profiles.durable
    monkeypatch.setattr(profiles, "durable", lambda df: scans.append(1) or real(df))
    box = box_stats(table, "x", "g")
    box.collect()
    assert len(scans) == 2
    # what is left to do reads stored tables only
    assert path not in box._jdf.queryExecution().executedPlan().toString()
    x = np.sqrt(np.arange(5000))[np.arange(5000) % 3 == 1]
    row = box.filter("group = '1'").first()
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high) == pytest.approx((q1, q2, q3, inside.min(), inside.max()))


def test_boxes_with_far_values_and_ties(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(0, 4, 3000), [500, 501, -300, 9, -6]]).astype(float)
    df = spark.createDataFrame([(float(v), "g") for v in x], "x double, g string")
    row = box_stats(df, "x", "g").first()
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert tuple(row)[1:] == pytest.approx((len(x), x.mean(), inside.min(), q1, q2, q3, inside.max()))


def test_shapes_of_skewed_columns_look_at_positive_values(spark):
    rng = np.random.default_rng(9)
    x = np.where(rng.random(4000) < 0.7, 0.0, rng.lognormal(3, 2, 4000).round(2))
    x[:50] = -5.0
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    row = shape_profile(df, ["x"]).first()
    assert row.skewed and not row.discrete and not row.clipped
    assert row.high_quantile == pytest.approx(np.quantile(x[x > 0], 0.995)) and row.max == x.max()


def test_discrete_bins_beyond_two_billion(spark):
    df = spark.createDataFrame([(0.0, "a"), (3e9, "a"), (3e9, "b")], "x double, g string")
    rows = {(r.group, r.bin): r.n for r in histogram(df, "x", "g", scale="discrete").collect()}
    assert rows == {("a", 0): 1, ("a", 3_000_000_000): 1, ("b", 3_000_000_000): 1}
    with pytest.raises(AnalysisError, match="infinite"):
        histogram(df.unionByName(spark.createDataFrame([(float("inf"), "a")], df.schema)), "x", "g")


def test_levels_are_eliminated_and_heavy_ones_kept(spark, buyers, both, monkeypatch):
    """No solver over all levels; the same model whichever levels are eliminated, and by the solver where too many are left."""
    from outcome_lens.operators import wide as module

    want = {(r.feature, r.level): r.coef for r in wide_coefficients(both[0]).collect()}
    assert both[0].effects is not None and len(both[0].coefficients) < 10
    asked = [("age", None), ("kind", "a"), ("the shop", "2"), ("the shop", "3")]
    errors = [r.se for r in wide_coefficient_stats(both[0], asked).collect()]
    for setting, value in (("LIGHT_ROWS", 20), ("MOST_DENSE", 0)):
        monkeypatch.setattr(module, setting, value)
        other = fit_wide(buyers, ["age"], ["the shop", "kind"], BOUGHT)
        got = {(r.feature, r.level): r.coef for r in wide_coefficients(other).collect()}
        assert got.keys() == want.keys() and [got[k] for k in want] == pytest.approx(list(want.values()), abs=1e-4)
        assert [r.se for r in wide_coefficient_stats(other, asked).collect()] == pytest.approx(errors, rel=1e-3)
    assert other.effects is None


def test_effects_of_levels_far_from_zero():
    from outcome_lens.operators.wide import level_effects

    owner, eta = np.repeat([0, 1, 2], [5000, 1, 2]), np.repeat([-30.0, 0.0, 3.0], [5000, 1, 2])
    y = np.repeat([1.0, 0.0, 1.0], [5000, 1, 2])
    effect = level_effects(eta, y, owner, np.array([True, True, False]), 1.0)
    slope = np.bincount(owner, y - 1 / (1 + np.exp(-eta - effect[owner]))) - effect
    assert abs(slope[:2]).max() < 1e-6 and effect[2] == 0
