"""Metrics and curves over any labelled score; no model is involved."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import Tables, bind
from outcome_lens.operators.curves import (
    average_precision,
    best_f1_threshold,
    classification_metrics,
    compare_thresholds,
    confusion,
    pr_curve,
    roc_auc,
)

# quality against the length of a document: a score with real ties
GRADES = "(SELECT quality AS label, CAST(n_chars AS DOUBLE) AS score FROM documents JOIN labels USING (doc_id))"
# returned lines against quantity: many rows, fifty scores
RETURNS = "(SELECT CAST(l_returnflag = 'R' AS INT) AS label, l_quantity / 50 AS score FROM lineitem)"
# high discount value against quantity: a score that ranks well
DISCOUNTS = "(SELECT CAST(l_quantity * l_discount > 1.2 AS INT) AS label, l_quantity / 51 AS score, l_orderkey AS k FROM lineitem)"


def _grades(t: Tables):
    return t.documents.join(t.labels, "doc_id").select(F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"))


def _returns(t: Tables):
    return t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_quantity") / 50).alias("score"))


def _discounts(t: Tables):
    high = F.col("l_quantity") * F.col("l_discount") > 1.2
    return t.lineitem.select(high.cast("int").alias("label"), (F.col("l_quantity") / 51).alias("score"), F.col("l_orderkey").alias("k"))


def counts_sql(scored: str, threshold: str) -> str:
    return f"""
    SELECT count(*) FILTER (WHERE label = 0 AND score < {threshold}) AS tn, count(*) FILTER (WHERE label = 0 AND score >= {threshold}) AS fp,
           count(*) FILTER (WHERE label = 1 AND score < {threshold}) AS fn, count(*) FILTER (WHERE label = 1 AND score >= {threshold}) AS tp
    FROM {scored}
    """


METRIC_SQL = """
    coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
"""
METRICS = ["accuracy", "precision", "recall", "f1"]


def auc_sql(scored: str) -> str:
    """Mann-Whitney over score groups: positives times negatives below, ties half."""
    return f"""
    WITH g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS q FROM {scored} GROUP BY score),
         w AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
    SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(q) AS BIGINT) AS negatives,
           sum(p * (below + q / 2)) / (CAST(sum(p) AS DOUBLE) * sum(q)) AS roc_auc FROM w
    """


def curve_sql(scored: str) -> str:
    return f"""
    SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / (tp + fp) AS precision, tp / all_p AS recall,
           2 * tp / (tp + fp + all_p) AS f1, p
    FROM (SELECT score, p, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER () AS all_p
          FROM (SELECT score, sum(label) AS p, count(*) - sum(label) AS q FROM {scored} GROUP BY score)
          WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    """


def precision_sql(scored: str) -> str:
    return f"SELECT sum(p * precision) / sum(p) AS average_precision FROM ({curve_sql(scored)})"


def best_sql(scored: str) -> str:
    return f"SELECT threshold, f1 FROM ({curve_sql(scored)}) ORDER BY f1 DESC, threshold LIMIT 1"


@bind(counts_sql(RETURNS, "0.5"))
def m6_confusion(t: Tables):
    return confusion(_returns(t))


@bind(f"SELECT CAST(0.7 AS DOUBLE) AS threshold, tn, fp, fn, tp, {METRIC_SQL} FROM ({counts_sql(DISCOUNTS, '0.7')})", ["threshold", *METRICS])
def m7_classification_metrics(t: Tables):
    return classification_metrics(_discounts(t), 0.7)


@bind(f"SELECT CAST(9 AS DOUBLE) AS threshold, tn, fp, fn, tp, {METRIC_SQL} FROM ({counts_sql(RETURNS, '9.0')})", ["threshold", *METRICS])
def m7_metrics_nothing_predicted(t: Tables):
    return classification_metrics(_returns(t), 9.0)


@bind(auc_sql(GRADES), ["roc_auc"])
def m8_roc_auc(t: Tables):
    return roc_auc(_grades(t))


@bind(f"SELECT a.positives, a.negatives, b.average_precision FROM ({auc_sql(GRADES)}) a, ({precision_sql(GRADES)}) b", ["average_precision"])
def m9_average_precision(t: Tables):
    return average_precision(_grades(t))


@bind(f"SELECT * EXCLUDE (p) FROM ({curve_sql(GRADES)})", ["threshold", "precision", "recall", "f1"])
def m10_pr_curve(t: Tables):
    return pr_curve(_grades(t))


# a price is nearly unique: thousands of thresholds
PRICES = "(SELECT CAST(l_quantity > 25 AS INT) AS label, l_extendedprice AS score FROM lineitem)"


@bind(f"SELECT * EXCLUDE (p) FROM ({curve_sql(PRICES)})", ["threshold", "precision", "recall", "f1"])
def m10_pr_curve_sliced(t: Tables):
    prices = t.lineitem.select((F.col("l_quantity") > 25).cast("int").alias("label"), F.col("l_extendedprice").alias("score"))
    return pr_curve(prices)


@bind(best_sql(GRADES), ["threshold", "f1"])
def m11_best_f1_threshold(t: Tables):
    return best_f1_threshold(_grades(t))


def thresholds_sql(tune: str, test: str) -> str:
    def at(kind: str, threshold: str) -> str:
        return f"""
        SELECT '{kind}' AS kind, {threshold} AS threshold, tn, fp, fn, tp, {METRIC_SQL}, roc_auc, average_precision
        FROM ({counts_sql(test, threshold)}), ({auc_sql(test)}), ({precision_sql(test)})
        """

    return at("default", "CAST(0.5 AS DOUBLE)") + " UNION ALL " + at("tuned", f"(SELECT threshold FROM ({best_sql(tune)}))")


@bind(
    thresholds_sql(f"(SELECT * FROM {DISCOUNTS} WHERE k % 3 <> 0)", f"(SELECT * FROM {DISCOUNTS} WHERE k % 3 = 0)"),
    ["threshold", *METRICS, "roc_auc", "average_precision"],
)
def m13_compare_thresholds(t: Tables):
    d = _discounts(t)
    return compare_thresholds(d.filter("k % 3 <> 0"), d.filter("k % 3 = 0"))
