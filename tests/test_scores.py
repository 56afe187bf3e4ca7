"""Curves and metrics against direct computation, and conclusions that must follow their input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcome_lens.operators.curves import (
    best_f1_threshold,
    classification_metrics,
    compare_thresholds,
    confusion,
    pr_curve,
    ranking_metrics,
)
from outcome_lens.plans.conclusions import (
    conclusions,
    equality_verdict,
    strategy_verdict,
    strongest,
)


def frame(spark, labels, scores):
    rows = [(int(y), float(p)) for y, p in zip(labels, scores, strict=True)]
    return spark.createDataFrame(rows, "label int, score double")


@pytest.fixture(scope="module")
def tied():
    """Scores with many ties, a third of all rows on one score."""
    rng = np.random.default_rng(5)
    scores = np.round(rng.random(900), 2)
    scores[rng.random(900) < 1 / 3] = 0.37
    return (rng.random(900) < 0.2 + 0.5 * scores).astype(int), scores


def test_ranking_metrics_equal_all_pairs(spark, tied):
    y, p = tied
    row = ranking_metrics(frame(spark, y, p)).first()
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert row["roc_auc"] == pytest.approx(pairs / (len(pos) * len(neg)), rel=1e-12)
    ap, last = 0.0, 0.0
    for cut in sorted(set(p), reverse=True):
        hit = p >= cut
        recall = y[hit].sum() / y.sum()
        ap, last = ap + (recall - last) * y[hit].mean(), recall
    assert row["average_precision"] == pytest.approx(ap, rel=1e-12)


def test_curve_and_best_threshold(spark, tied):
    y, p = tied
    df = frame(spark, y, p)
    best = (-1.0, 0.0)
    curve = {r["threshold"]: r for r in pr_curve(df).collect()}
    assert set(curve) == set(p)
    for cut in sorted(curve):
        hit = p >= cut
        tp, fp, fn = y[hit].sum(), (1 - y[hit]).sum(), y[~hit].sum()
        f1 = 2 * tp / (2 * tp + fp + fn)
        assert (curve[cut]["tp"], curve[cut]["fp"]) == (tp, fp) and curve[cut]["f1"] == pytest.approx(f1)
        if f1 > best[0]:
            best = (f1, cut)
    row = best_f1_threshold(df).first()
    assert (row["f1"], row["threshold"]) == pytest.approx(best)


def test_separated_scores(spark):
    rng = np.random.default_rng(31)
    low, high = rng.uniform(0, 0.45, 11), rng.uniform(0.55, 1, 6)
    df = frame(spark, [0] * 11 + [1] * 6, [*map(float, low), *map(float, high)])
    assert best_f1_threshold(df).first()["threshold"] == high.min()  # the lowest that keeps all positives and nothing else
    row = ranking_metrics(df).first()
    assert row["roc_auc"] == 1.0 and row["average_precision"] == 1.0


def test_scores_and_labels_must_be_there(spark):
    for row in ((1, None), (0, float("nan")), (None, 0.5), (2, 0.5)):
        bad = spark.createDataFrame([(1, 0.4), (0, 0.2), row], "label int, score double")
        for metric in (confusion, ranking_metrics, best_f1_threshold):
            with pytest.raises(Exception, match="score that is no number"):
                metric(bad).collect()


def test_one_class_and_no_rows(spark):
    ones = frame(spark, [1, 1], [0.3, 0.6])
    assert ranking_metrics(ones).first()["roc_auc"] is None and ranking_metrics(ones).first()["average_precision"] == 1.0
    none = ones.limit(0)
    assert best_f1_threshold(none).first()["threshold"] == 0.5
    row = classification_metrics(none).first()
    assert [row[c] for c in ("tn", "fp", "fn", "tp", "accuracy", "f1")] == [0, 0, 0, 0, 0.0, 0.0]
    # without a positive every F1 is 0, and the lowest threshold is taken
    assert best_f1_threshold(frame(spark, [0, 0], [0.3, 0.6])).first()["threshold"] == 0.3


def test_metrics_reproduce_the_published_matrices(spark):
    table = spark.createDataFrame([(10522, 833, 1462, 2238, 0.8476, 0.7288, 0.6049, 0.6611), (9512, 1843, 819, 2881, 0.8232, 0.6099, 0.7786, 0.6840)],
                                  "tn long, fp long, fn long, tp long, a double, p double, r double, f double")
    for r in table.collect():
        parts = [(0, 0.1, r["tn"]), (0, 0.9, r["fp"]), (1, 0.1, r["fn"]), (1, 0.9, r["tp"])]
        df = spark.createDataFrame(parts, "label int, score double, n long").select("label", "score", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        found = classification_metrics(df).first()
        assert [found[c] for c in ("accuracy", "precision", "recall", "f1")] == pytest.approx([r["a"], r["p"], r["r"], r["f"]], abs=5e-5)
        assert found["recall"] == found["tp"] / (found["tp"] + found["fn"])


def test_a_score_at_the_threshold_is_positive(spark):
    row = confusion(frame(spark, [0, 1, 1], [0.5, 0.5, 0.49])).first()
    assert tuple(row) == (0, 1, 1, 1)


def test_results_do_not_depend_on_partitions(spark, tied):
    df = frame(spark, *tied)
    few, many = ranking_metrics(df.coalesce(1)).first(), ranking_metrics(df.repartition(16)).first()
    assert few["roc_auc"] == pytest.approx(many["roc_auc"], rel=1e-13)


def test_weights_stand_for_copies(spark, tied):
    df = frame(spark, *tied)
    counted = df.groupBy("label", "score").agg(F.count("*").alias("w"))
    for metric in (ranking_metrics, confusion, best_f1_threshold):
        assert list(metric(df).first()) == pytest.approx(list(metric(counted, weight="w").first()), rel=1e-12)


def test_threshold_rows_share_the_ranking(spark, tied):
    df = frame(spark, *tied)
    rows = {r["kind"]: r for r in compare_thresholds(df, df).collect()}
    assert rows["default"]["threshold"] == 0.5 and rows["tuned"]["f1"] >= rows["default"]["f1"]
    assert rows["default"]["roc_auc"] == rows["tuned"]["roc_auc"]


def test_strategy_verdict_needs_a_gap(spark):
    def verdict(*scores):
        return strategy_verdict(spark.createDataFrame([(f"s{i}", v) for i, v in enumerate(scores)], "strategy string, f1 double")).first()

    close = verdict(0.4124, 0.412, 0.4122)
    assert close["tie"] and close["winner"] is None
    clear = verdict(0.31, 0.44, 0.58)
    assert clear["winner"] == "s2" and clear["gap"] == pytest.approx(0.27) and not clear["tie"]
    alone = verdict(0.27)
    assert alone["winner"] == "s0" and alone["gap"] == 0.0


COEFS = "feature string, level string, name string, coef double, se double, odds_ratio double, or_low double, or_high double"


def coefs(spark, *rows):
    return spark.createDataFrame([(f, lv, f"{f}_{lv}", c, 0.1, o, low, high) for f, lv, c, o, low, high in rows], COEFS)


def test_strongest_is_by_absolute_value(spark):
    table = coefs(spark, ("a", "x", 0.5, 1.6, 1.2, 2.0), ("b", "y", -2.0, 0.13, 0.1, 0.2))
    assert strongest(table).first()["name"] == "b_y"


def test_conclusions_flip_with_their_input(spark):
    def facts(**results):
        return {(r["fact"], r["item"]): r for r in conclusions(**results).collect()}

    test = "cramers_v double, significant boolean"
    for significant, text in ((True, "dependent"), (False, "independence not rejected")):
        found = facts(chi_square=spark.createDataFrame([(0.2, significant)], test))
        assert found["independence", ""]["verdict"] == text
    for low, high, text in ((0.3, 0.5, "lowers the odds"), (1.2, 2.0, "raises the odds"), (0.8, 1.1, "direction open")):
        found = facts(coefs=coefs(spark, ("sex", "F", 0.1, (low + high) / 2, low, high), ("race", "B", 0.05, 1.0, 0.9, 1.1)), focus="sex")
        assert found["focus term", "sex_F"]["verdict"] == text and ("focus term", "race_B") not in found
    kinds = "kind string, fn long, recall double, threshold double"
    for fn, text in ((819, "fewer missed"), (2000, "more missed"), (1462, "same")):
        found = facts(thresholds=spark.createDataFrame([("default", 1462, 0.6, 0.5), ("tuned", fn, 0.7, 0.3)], kinds))
        assert found["change in missed positives", ""]["verdict"] == text
        assert found["change in missed positives", ""]["value"] == fn - 1462


def test_equality_verdict_names_the_mismatches(spark):
    schema = "columns_match boolean, rows_match boolean, type_mismatch long, null_mismatch long, value_mismatch long, identical boolean"
    rows = [(True, True, 0, 0, 0, True), (True, True, 1, 2, 3, False), (False, True, 0, None, None, False)]
    found = [r["verdict"] for r in equality_verdict(spark.createDataFrame(rows, schema)).collect()]
    assert found == ["identical", "mismatches: types 1, nulls 2, values 3", "not comparable"]
