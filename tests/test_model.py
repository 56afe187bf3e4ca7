"""The model against an independent Newton solution, and the rules around it."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from outcome_lens import session
from outcome_lens.__main__ import census_spec, main
from outcome_lens.contract import (
    CENSUS,
    CENSUS_CATEGORICAL_FEATURES,
    CENSUS_NUMERIC_FEATURES,
    AnalysisError,
    Outcome,
)
from outcome_lens.operators.design import design_metadata, encode, fit_design, fit_fold_designs
from outcome_lens.operators.levels import level_counts, reference_levels
from outcome_lens.operators.logistic import (
    annotate_coefficients,
    coefficient_stats,
    compare_strategies,
    fit_logistic,
    fit_score,
    fold_balance,
    hash_fold,
    out_of_fold,
    posterior_variance,
    score,
    sensitivity,
    stratified_folds,
    threshold_analysis,
)
from outcome_lens.plans.outcome_report import outcome_report
from outcome_lens.sources import read_results
from outcome_lens.sources.models import load_model, save_and_verify

NUM, CAT = CENSUS_NUMERIC_FEATURES, CENSUS_CATEGORICAL_FEATURES
BOUGHT = Outcome("bought", "y")


@pytest.fixture(scope="module")
def buyers(spark):
    """400 rows with signal in a number and two categories, one level held by most rows."""
    rng = np.random.default_rng(11)
    age = rng.normal(40, 12, 400).round(1)
    place = rng.choice(["home", "shop", "web.site"], 400, p=[0.15, 0.6, 0.25])
    tier = rng.choice(["1", "2"], 400)
    eta = 0.05 * (age - 40) + (place == "web.site") * 1.2 - (tier == "2") * 0.7 - 0.2
    bought = np.where(rng.random(400) < 1 / (1 + np.exp(-eta)), "y", "n")
    rows = [(i, float(a), str(p), str(t), str(b)) for i, (a, p, t, b) in enumerate(zip(age, place, tier, bought, strict=True))]
    return spark.createDataFrame(rows, "id long, age double, `place-of` string, tier string, bought string").cache()


def newton(rows, c=1.0):
    """Coefficients and Laplace errors from the dense normal equations."""
    age = np.array([r["age"] for r in rows])
    z = (age - age.mean()) / age.std()
    columns = [np.ones(len(rows)), z]
    for col, levels in (("place-of", ["home", "web.site"]), ("tier", None)):
        values = [r[col] for r in rows]
        if levels is None:
            common = max(sorted(set(values)), key=values.count)
            levels = [v for v in sorted(set(values)) if v != common]
        columns += [np.array([float(v == lv) for v in values]) for lv in levels]
    x = np.column_stack(columns)
    y = np.array([r["bought"] == "y" for r in rows], dtype=float)
    penalty = np.eye(x.shape[1]) / c
    penalty[0, 0] = 0
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + penalty
        beta += np.linalg.solve(hessian, x.T @ (y - p) - penalty @ beta)
    return beta, np.sqrt(np.diag(np.linalg.inv(hessian)))


@pytest.mark.parametrize("c", [1.0, 0.05])
def test_coefficients_and_errors_equal_newton(buyers, c):
    fitted = fit_logistic(buyers, ["age"], ["place-of", "tier"], BOUGHT, c=c, tol=1e-10)
    beta, se = newton(buyers.collect(), c)
    assert fitted.intercept == pytest.approx(beta[0], abs=1e-6)
    assert fitted.coefficients == pytest.approx(list(beta[1:]), abs=1e-6)
    stats = {r["name"]: r for r in coefficient_stats(fitted, buyers).collect()}
    names = ["age", "place-of_home", "place-of_web.site"]
    assert [stats[n]["se"] for n in names] == pytest.approx(list(se[1:4]), abs=1e-6)
    for r in stats.values():
        assert r["or_low"] < r["odds_ratio"] < r["or_high"] and r["odds_ratio"] == pytest.approx(math.exp(r["coef"]))
    assert list(stats) == sorted(stats, key=lambda n: stats[n]["coef"])


def test_errors_do_not_depend_on_partitions(buyers):
    fitted = fit_logistic(buyers, ["age"], ["place-of"], BOUGHT)
    one = [r["se"] for r in coefficient_stats(fitted, buyers.coalesce(1)).collect()]
    many = [r["se"] for r in coefficient_stats(fitted, buyers.repartition(16)).collect()]
    assert one == pytest.approx(many, rel=1e-10)


def test_design_drops_the_reference_and_zeroes_unseen_levels(spark, buyers):
    design = fit_design(buyers, ["age"], ["place-of", "tier"], BOUGHT)
    assert design.reference["place-of"][0] == "shop"
    assert ("place-of", "shop") not in design.features and len(design.features) == 4
    assert design.scales["age"] == pytest.approx(np.std([r["age"] for r in buyers.collect()]))
    new = spark.createDataFrame([(1, design.means["age"], "moon", None, "n")], buyers.schema)
    assert encode(new, design).select(vector_to_array("features").alias("v")).first()["v"] == [0.0] * 4
    dropped = {r["feature"]: r["level"] for r in design_metadata(buyers, design).filter("is_dropped").collect()}
    assert dropped == {c: ref for c, (ref, _) in design.reference.items()}


def test_fold_designs_equal_designs_of_the_other_folds(buyers):
    marked = buyers.withColumn("fold", (F.col("id") % 3).cast("int"))
    for i, mine in enumerate(fit_fold_designs(marked, ["age"], ["place-of"], BOUGHT, "fold", 3)):
        alone = fit_design(marked.filter(F.col("fold") != i), ["age"], ["place-of"], BOUGHT)
        assert (mine.rows, mine.positives, mine.levels) == (alone.rows, alone.positives, alone.levels)
        assert mine.scales["age"] == pytest.approx(alone.scales["age"]) and mine.means["age"] == pytest.approx(alone.means["age"])


def test_constant_columns_do_not_break_the_fit(people):
    fitted = fit_logistic(people, NUM, CAT, CENSUS.outcome)  # capital-loss and native-country are constant
    assert fitted.design.scales["capital-loss"] == 1.0
    names = {f"{f}_{lv}" if lv else f for f, lv in fitted.design.features}
    assert not any(n.startswith("native-country_") for n in names)
    for column in CAT:
        levels = people.select(f"`{column}`").distinct().count()
        assert sum(f == column for f, _ in fitted.design.features) == levels - 1


def test_errors_grow_as_levels_get_rarer(spark):
    rng = np.random.default_rng(17)
    sizes = {"base": 900, "often": 260, "seldom": 60, "hardly": 12}
    rows = [(level, float(rng.normal()), str(rng.choice(["y", "n"]))) for level, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "level string, x double, bought string")
    fitted = fit_logistic(df, ["x"], ["level"], BOUGHT, c=1000.0)
    se = {r["name"]: r["se"] for r in coefficient_stats(fitted, df).collect()}
    assert se["level_often"] < se["level_seldom"] < se["level_hardly"]


def test_model_columns_that_determine_each_other_are_refused():
    gram = pd.DataFrame({"i": [0, 0, 1], "j": [0, 1, 1], "value": [4.0, 4.0, 4.0]})
    frame = type("Gram", (), {"toPandas": lambda self: gram})()
    with pytest.raises(AnalysisError, match="determine each other"):
        posterior_variance(frame, 1, float("inf"))
    assert posterior_variance(frame, 1, 0.5) == pytest.approx(np.linalg.inv([[4.0, 4.0], [4.0, 6.0]])[1, 1])


def test_folds_must_be_the_ones_asked_for(spark, buyers):
    shifted = buyers.withColumn("id", F.col("id") - 200)
    with pytest.raises(AnalysisError, match="folds must be exactly"):
        out_of_fold(shifted, ["age"], ["tier"], BOUGHT, F.col("id") % 4, k=4)
    with pytest.raises(AnalysisError, match="without a fold: True"):
        out_of_fold(buyers, ["age"], ["tier"], BOUGHT, F.when(F.col("id") > 3, F.col("id") % 4), k=4)
    scored = out_of_fold(shifted, ["age"], ["tier"], BOUGHT, F.pmod("id", F.lit(4)), k=4)
    assert scored.count() == 400


def test_scoring_keeps_all_columns(buyers):
    fitted = fit_logistic(buyers, ["age"], ["tier"], BOUGHT)
    kept = score(fitted.model, buyers.withColumn("__key", F.col("id")).withColumn("a.b", F.lit(1)), BOUGHT)
    assert kept.columns == [*buyers.columns, "__key", "a.b", "score", "label", "predicted"]
    for name in ("score", "Label", "features", "probability", "__z0"):
        with pytest.raises(AnalysisError, match="rename"):
            score(fitted.model, buyers.withColumn(name, F.lit(1)), BOUGHT)


def test_out_of_fold_scores_come_from_models_that_did_not_see_the_row(buyers):
    fold = F.col("id") % 4
    held = {r["id"]: r["score"] for r in out_of_fold(buyers, ["age"], ["tier"], BOUGHT, fold, k=4).collect()}
    assert len(held) == 400
    fitted = fit_logistic(buyers.filter("id % 4 <> 2"), ["age"], ["tier"], BOUGHT)
    for r in score(fitted.model, buyers.filter("id % 4 = 2"), BOUGHT).collect():
        assert held[r["id"]] == pytest.approx(r["score"], abs=1e-6)
    # changing the labels of a fold must not change its own scores
    flipped = buyers.withColumn("bought", F.when(F.col("id") % 4 == 2, F.when(F.col("bought") == "y", "n").otherwise("y")).otherwise(F.col("bought")))
    again = {r["id"]: r["score"] for r in out_of_fold(flipped, ["age"], ["tier"], BOUGHT, fold, k=4).collect()}
    assert all(again[i] == pytest.approx(held[i], abs=1e-6) for i in held if i % 4 == 2)
    assert any(abs(again[i] - held[i]) > 1e-3 for i in held if i % 4 != 2)


def test_stratified_folds_are_balanced_and_stable(buyers):
    done = stratified_folds(buyers, BOUGHT, ["id"])
    assert done.columns == [*buyers.columns, "fold"]
    rows = fold_balance(done, BOUGHT, F.col("fold")).collect()
    assert max(r["positives"] for r in rows) - min(r["positives"] for r in rows) <= 1
    assert max(r["n"] for r in rows) - min(r["n"] for r in rows) <= 2
    other = stratified_folds(buyers.repartition(7), BOUGHT, ["id"])
    assert sorted(tuple(r) for r in done.select("id", "fold").collect()) == sorted(tuple(r) for r in other.select("id", "fold").collect())


def test_hash_folds_cover_all_folds(buyers):
    assert {r["fold"] for r in buyers.select(hash_fold(["id"]).alias("fold")).distinct().collect()} == set(range(5))


def test_saved_model_predicts_the_same(buyers, tmp_path):
    fitted = fit_logistic(buyers, ["age"], ["place-of"], BOUGHT)
    assert tuple(save_and_verify(fitted.model, buyers, str(tmp_path / "m")).first()) == (400, 0)
    with pytest.raises(AnalysisError):
        load_model(str(tmp_path / "absent"))


def test_strategies_share_the_test_set(buyers):
    rows = {r["strategy"]: r for r in compare_strategies({"a": buyers, "b": buyers.filter("id < 300")}, buyers, ["age"], ["tier"], BOUGHT).collect()}
    assert rows["a"]["test_rows"] == rows["b"]["test_rows"] == 400 and rows["b"]["train_rows"] == 300


def test_sensitivity_refits_without_a_column(buyers):
    found = sensitivity(buyers, buyers, ["age"], ["place-of", "tier"], BOUGHT, excluded="place-of", focus="tier").collect()
    assert len(found) == 1 and found[0]["excluded"] == "place-of" and found[0]["reference"] in ("1", "2")
    direct = fit_logistic(buyers, ["age"], ["tier"], BOUGHT)
    assert found[0]["coef"] == pytest.approx(direct.coefficients[1], abs=1e-6)


def test_threshold_rows(buyers):
    fitted, metrics = fit_score(buyers, buyers, ["age"], ["place-of"], BOUGHT)
    rows = {r["kind"]: r for r in threshold_analysis(fitted, buyers, buyers, F.col("id") % 5).collect()}
    assert rows["default"]["threshold"] == 0.5 and 0 <= rows["tuned"]["threshold"] <= 1
    assert rows["default"]["f1"] == pytest.approx(metrics.first()["f1"])


def test_annotations_carry_contrast_and_sizes(buyers):
    fitted = fit_logistic(buyers, ["age"], ["place-of"], BOUGHT)
    noted = annotate_coefficients(
        coefficient_stats(fitted, buyers), level_counts(buyers, ["place-of"]), reference_levels(buyers, ["place-of"]), 400
    )
    found = {r["name"]: r for r in noted.collect()}
    assert found["age"]["contrast"] == "1 SD" and found["age"]["n"] == 400 and found["age"]["n_reference"] is None
    home = buyers.filter("`place-of` = 'home'").count()
    assert found["place-of_home"]["contrast"] == "place-of=shop" and found["place-of_home"]["n"] == home


def test_one_class_and_empty_input_are_refused(buyers):
    for rows in (buyers.filter("bought = 'y'"), buyers.limit(0)):
        with pytest.raises(AnalysisError):
            fit_logistic(rows, ["age"], ["tier"], BOUGHT)
    with pytest.raises(AnalysisError, match="not in the table"):
        fit_logistic(buyers, ["height"], [], BOUGHT)
    with pytest.raises(AnalysisError):
        fit_logistic(buyers, [], [], BOUGHT)


def test_whole_census_report(people, drawn):
    found = outcome_report(people, people, census_spec())
    facts = {(r["fact"], r["item"]): r for r in found["facts"].collect()}
    assert facts["mean difference", ""]["verdict"] == "different"
    hours = drawn.groupby("income")["hours-per-week"].mean()
    assert facts["mean difference", ""]["value"] == pytest.approx(hours[">50K"] - hours["<=50K"])
    assert found["overlap"].first()["test_rows_hit"] == len(drawn)
    assert found["strategies"].count() == 2 and found["topcode_capital-gain"].first()["capped_rows"] == 0
    assert {r["end"] for r in found["strongest_coefficients"].collect()} == {"top", "bottom"}
    assert found["rates_education"].filter("kind = 'level'").count() == drawn["education"].nunique()


def test_report_builds_only_what_is_asked_for(people):
    assert set(outcome_report(people, people, census_spec(), tables=["overlap"])) == {"overlap"}
    with pytest.raises(AnalysisError, match="no result table"):
        outcome_report(people, people, census_spec(), tables=["absent"])


def test_counting_equal_rows_changes_no_result(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, int(n), str(g), "y" if rng.random() < 0.2 + 0.1 * n else "n") for i, (n, g) in enumerate(zip(rng.integers(0, 4, 800), rng.choice(["a", "b"], 800), strict=True))]
    df = spark.createDataFrame(rows, "id long, n int, g string, bought string")
    found = []
    for pays in (1, 10**9):  # always group, never group
        monkeypatch.setattr("outcome_lens.operators.design.GROUPING_PAYS", pays)
        fitted, metrics = fit_score(df, df, ["n"], ["g"], BOUGHT)
        se = [r["se"] for r in coefficient_stats(fitted, df).collect()]
        tuned = [tuple(r)[1:] for r in threshold_analysis(fitted, df, df, F.col("id") % 5).orderBy("kind").collect()]
        found.append([*fitted.coefficients, *se, *metrics.first(), *tuned[0], *tuned[1]])
    assert found[0] == pytest.approx(found[1], rel=1e-5, abs=1e-6)


def test_job_writes_its_results(spark, people, tmp_path):
    def file(name, dotted):
        lines = [", ".join(str(v) for v in r) + ("." if dotted else "") for r in people.collect()]
        path = tmp_path / name
        path.write_text("|comment\n" + "\n".join(lines) + "\n")
        return str(path)

    out, before = str(tmp_path / "out"), list(session._stored)
    assert main([file("train", False), file("test", True), out, "r1"]) == 0
    assert read_results(spark, out, "reader_difference_test", "r1").count() == 0
    assert read_results(spark, out, "saved_model", "r1").first()["mismatches"] == 0
    assert read_results(spark, out, "facts", "r1").filter("fact = 'readers' and verdict = 'identical'").count() == 2
    assert read_results(spark, out, "histogram", "r1").count() > 0 and read_results(spark, out, "scales", "r1").count() == len(NUM)
    assert session._stored == before  # what the job stored on the way is gone
    assert main([str(tmp_path / "absent"), str(tmp_path / "absent"), out]) == 1
    assert main([]) == 2


def test_census_features():
    assert NUM == ["age", "education-num", "capital-gain", "capital-loss", "hours-per-week"]
    assert CAT == ["workclass", "marital-status", "occupation", "relationship", "race", "sex", "native-country"]
