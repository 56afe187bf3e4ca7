"""The model and what is read from it; fits are checked against Newton steps in SQL."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from bindings.newton import NewtonSql
from bindings.registry import Tables, bind
from bindings.scores import METRIC_SQL, METRICS, auc_sql, best_sql, counts_sql, precision_sql
from outcome_lens.contract import Outcome
from outcome_lens.operators.design import design_metadata, encode, fit_design, fit_encoder, fit_scaler
from outcome_lens.operators.levels import level_counts, reference_levels
from outcome_lens.operators.logistic import (
    annotate_coefficients,
    coefficient_stats,
    compare_strategies,
    fit_logistic,
    fit_score,
    fold_balance,
    gram_matrix,
    out_of_fold,
    score,
    sensitivity,
    stratified_folds,
    threshold_analysis,
)
from outcome_lens.operators.quality import fill_unknown
from outcome_lens.operators.rates import outcome_rate
from outcome_lens.plans.conclusions import strategy_verdict, strongest
from outcome_lens.session import new_path
from outcome_lens.sources.models import save_and_verify

COSTLY = Outcome("cost", "high")
NUMERIC, CATEGORICAL = ["l_quantity"], ["l_linestatus"]
STATUS = {"l_linestatus": ["F", "O"]}

# whether quantity times discount is high: an outcome that quantity predicts, though not fully
LINES = "(SELECT *, CAST(l_quantity * l_discount > 1.2 AS INT) AS y FROM lineitem)"
TRAIN, TEST = "l_orderkey % 3 <> 0", "l_orderkey % 3 = 0"
WHOLE_MODEL = f"SELECT 1 AS g, y, l_quantity, l_linestatus FROM {LINES}"
WHOLE_FOLDS = f"SELECT f.range AS g, y, l_quantity, l_linestatus FROM {LINES}, range(5) f WHERE l_orderkey % 5 <> f.range"
ONE_MODEL = f"SELECT 1 AS g, y, l_quantity, l_linestatus FROM {LINES} WHERE {TRAIN}"
FOLD_MODELS = f"SELECT f.range AS g, y, l_quantity, l_linestatus FROM {LINES}, range(5) f WHERE {TRAIN} AND l_orderkey % 5 <> f.range"


def _lines(t: Tables):
    return t.lineitem.withColumn("cost", F.when(F.col("l_quantity") * F.col("l_discount") > 1.2, "high").otherwise("low"))


def _split(t: Tables):
    lines = _lines(t)
    return lines.filter("l_orderkey % 3 <> 0"), lines.filter("l_orderkey % 3 = 0")


@bind(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_pop({c}) AS sd_pop, stddev_pop({c}) AS scale FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    )
    + """ UNION ALL SELECT 'constant', count(*), 4, 0, 1 FROM lineitem""",
    ["mean", "sd_pop", "scale"],
)
def m1_fit_scaler(t: Tables):
    return fit_scaler(t.lineitem.withColumn("constant", F.lit(4)), ["l_quantity", "l_extendedprice", "l_discount", "constant"])


def _encoder_sql(columns) -> str:
    counts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS level, count(*) AS n FROM part GROUP BY {c}""" for c in columns
    )
    return f"""
    SELECT "column", level, n, CASE WHEN level = ref THEN 0 ELSE sum(CAST(level <> ref AS BIGINT)) OVER
             (PARTITION BY "column" ORDER BY level ROWS UNBOUNDED PRECEDING) END AS slot, CAST(level = ref AS BIGINT) AS is_reference
    FROM (SELECT *, first_value(level) OVER (PARTITION BY "column" ORDER BY n DESC, level) AS ref FROM ({counts}))
    """


ENCODED = ["p_brand", "p_type"]
SLOTS_SQL = f"""SELECT "column", level, n, CAST(slot AS BIGINT) AS slot, is_reference FROM ({_encoder_sql(ENCODED)})"""


@bind(SLOTS_SQL)
def m2_fit_encoder(t: Tables):
    return fit_encoder(t.part, ENCODED)


@bind(
    f"""
    SELECT "column" || '_' || level AS name, CAST(n AS DOUBLE) AS total FROM ({SLOTS_SQL}) WHERE is_reference = 0
    UNION ALL SELECT 'p_size', 0.0
    """,
    ["total"],
    digits=5,
)
def m2_encoded_sums(t: Tables):
    design = fit_design(t.part, ["p_size"], ENCODED, Outcome("p_type", "PROMO"))
    sums = encode(t.part, design).agg(vector_to_array(Summarizer.sum(F.col("features"))).alias("_sums"))
    names = design_metadata(t.part, design).filter("not is_dropped").select("slot", "name")
    at = sums.select(F.posexplode("_sums").alias("slot", "total"))
    return names.join(at, "slot").select("name", "total")


@bind(
    f"""
    SELECT "column" AS feature, level, "column" || '_' || level AS name, CASE WHEN is_reference = 1 THEN '' ELSE "column" || '=' || ref END AS contrast,
           is_reference AS is_dropped
    FROM (SELECT *, max(CASE WHEN is_reference = 1 THEN level END) OVER (PARTITION BY "column") AS ref FROM ({SLOTS_SQL}))
    UNION ALL SELECT 'p_size', '', 'p_size', '1 SD', 0 FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)
    """
)
def m3_design_metadata(t: Tables):
    design = fit_design(t.part, ["p_size"], ENCODED, Outcome("p_type", "PROMO"))
    return design_metadata(t.part, design).select(
        "feature", F.coalesce("level", F.lit("")).alias("level"), "name", F.coalesce("contrast", F.lit("")).alias("contrast"), "is_dropped"
    )


def _fit_sql() -> str:
    fit = NewtonSql(WHOLE_MODEL, NUMERIC, STATUS)
    dummies = " UNION ALL ".join(
        f"SELECT 'l_linestatus_{v}', b{i + 2} FROM {fit.beta} JOIN facts USING (g) WHERE ref0 <> '{v}'" for i, (_, v) in enumerate(fit.dummies)
    )
    return f"{fit.with_clause()} SELECT 'intercept' AS name, b0 AS coef FROM {fit.beta} UNION ALL SELECT 'l_quantity', b1 FROM {fit.beta} UNION ALL {dummies}"


@bind(_fit_sql(), ["coef"], digits=4)
def m4_fit_logistic(t: Tables):
    fitted = fit_logistic(_lines(t), NUMERIC, CATEGORICAL, COSTLY)
    names = [f if level is None else f"{f}_{level}" for f, level in fitted.design.features]
    rows = [("intercept", fitted.intercept), *zip(names, fitted.coefficients, strict=True)]
    return t.spark.createDataFrame(rows, "name string, coef double")


def _scored_sql(fit: NewtonSql, rows: str) -> str:
    return f"(SELECT r.*, {fit.probability()} AS score FROM {rows} r JOIN {fit.beta} USING (g) JOIN facts USING (g))"


TEST_ROWS = f"(SELECT 1 AS g, y AS label, l_quantity, l_linestatus FROM {LINES} WHERE {TEST})"


def _score_sql() -> str:
    fit = NewtonSql(ONE_MODEL, NUMERIC, STATUS)
    return f"""{fit.with_clause()} SELECT l_quantity, l_linestatus, count(*) AS n, avg(score) AS score, CAST(sum(label) AS BIGINT) AS positives,
        count(*) FILTER (WHERE score >= 0.5) AS predicted FROM {_scored_sql(fit, TEST_ROWS)} GROUP BY 1, 2"""


@bind(_score_sql(), ["l_quantity", "score"], digits=4)
def m5_score(t: Tables):
    train, test = _split(t)
    scored = score(fit_logistic(train, NUMERIC, CATEGORICAL, COSTLY).model, test, COSTLY)
    return scored.groupBy("l_quantity", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("score"), F.sum("label").alias("positives"), F.sum("predicted").alias("predicted")
    )


@bind(
    """
    SELECT count(*) AS n, count(DISTINCT l_orderkey * 10 + l_linenumber) AS keys, CAST(sum(l_orderkey) AS DOUBLE) AS kept,
           CAST(sum(CAST(l_quantity * l_discount > 1.2 AS INT)) AS BIGINT) AS labels FROM lineitem
    """,
    ["kept"],
)
def m5_score_keeps_columns(t: Tables):
    """A column that looks internal, and one with a dot, go through scoring."""
    lines = _lines(t).withColumn("__key", F.col("l_orderkey") * 10 + F.col("l_linenumber")).withColumn("key.part", F.col("l_orderkey").cast("double"))
    scored = score(fit_logistic(lines, NUMERIC, CATEGORICAL, COSTLY).model, lines, COSTLY)
    return scored.filter("score between 0 and 1").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("__key").alias("keys"), F.sum("`key.part`").alias("kept"), F.sum("label").alias("labels")
    )


@bind(
    f"""
    SELECT l_orderkey % 5 AS fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, avg(y) AS positive_rate
    FROM {LINES} GROUP BY 1
    """,
    ["positive_rate"],
)
def m12_fold_balance(t: Tables):
    return fold_balance(_lines(t), COSTLY, F.col("l_orderkey") % 5)


@bind(
    """
    WITH c AS (SELECT c_mktsegment = 'BUILDING' AS k, count(*) AS n FROM customer GROUP BY 1),
         f AS (SELECT k, range AS fold, n // 5 + CAST(range < n % 5 AS BIGINT) AS n FROM c, range(5))
    SELECT fold, CAST(sum(n) AS BIGINT) AS n, CAST(sum(CASE WHEN k THEN n ELSE 0 END) AS BIGINT) AS positives FROM f GROUP BY fold
    """
)
def m12_stratified_folds(t: Tables):
    building = Outcome("c_mktsegment", "BUILDING")
    numbered = stratified_folds(t.customer, building, ["c_custkey"])
    return fold_balance(numbered, building, F.col("fold")).drop("positive_rate")


def _fold_scores(fit: NewtonSql, condition: str = "TRUE") -> str:
    rows = f"(SELECT l_orderkey % 5 AS g, y AS label, l_quantity, l_linestatus FROM {LINES} WHERE {condition})"
    return _scored_sql(fit, rows)


def _fold_sql() -> str:
    fit = NewtonSql(WHOLE_FOLDS, NUMERIC, STATUS)
    return f"""{fit.with_clause()} SELECT g AS fold, l_quantity, l_linestatus, count(*) AS n, avg(score) AS score
        FROM {_fold_scores(fit)} GROUP BY 1, 2, 3"""


@bind(_fold_sql(), ["l_quantity", "score"], digits=4)
def m12_out_of_fold(t: Tables):
    held = out_of_fold(_lines(t), NUMERIC, CATEGORICAL, COSTLY, F.col("l_orderkey") % 5)
    return held.groupBy("fold", "l_quantity", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("score"))


@bind("SELECT count(*) AS n, count(DISTINCT l_orderkey) AS keys FROM lineitem")
def m12_out_of_fold_negative_keys(t: Tables):
    """Keys on both sides of zero: folds are taken with a positive remainder, and no row is lost."""
    shifted = _lines(t).withColumn("l_orderkey", F.col("l_orderkey") - 7000)
    held = out_of_fold(shifted, NUMERIC, CATEGORICAL, COSTLY, F.pmod("l_orderkey", F.lit(5)))
    return held.filter("score between 0 and 1").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("keys"))


def metrics_sql(scored: str, threshold: str = "0.5") -> str:
    return f"""
    SELECT tn, fp, fn, tp, {METRIC_SQL}, roc_auc, average_precision FROM ({counts_sql(scored, threshold)}), ({auc_sql(scored)}), ({precision_sql(scored)})
    """


ALL_METRICS = [*METRICS, "roc_auc", "average_precision"]


def _threshold_sql() -> str:
    folds = NewtonSql(FOLD_MODELS, NUMERIC, STATUS)
    one = NewtonSql(ONE_MODEL, NUMERIC, STATUS)
    held = f"({folds.with_clause()} SELECT label, score FROM {_fold_scores(folds, TRAIN)})"
    test = f"({one.with_clause()} SELECT label, score FROM {_scored_sql(one, TEST_ROWS)})"
    return f"""
    WITH held AS MATERIALIZED {held}, tested AS MATERIALIZED {test}, best AS MATERIALIZED ({best_sql("held")})
    SELECT 'default' AS kind, CAST(0.5 AS DOUBLE) AS threshold, * FROM ({metrics_sql("tested")})
    UNION ALL SELECT 'tuned', (SELECT threshold FROM best), * FROM ({metrics_sql("tested", "(SELECT threshold FROM best)")})
    """


@bind(_threshold_sql(), ["threshold", *ALL_METRICS], digits=4)
def m13_threshold_analysis(t: Tables):
    train, test = _split(t)
    fitted = fit_logistic(train, NUMERIC, CATEGORICAL, COSTLY)
    return threshold_analysis(fitted, train, test, F.col("l_orderkey") % 5)


def _gram_sql() -> str:
    """Per-row averages of Z'WZ; the two dummy columns add up to that of the level in the model."""
    fit = NewtonSql(WHOLE_MODEL, NUMERIC, STATUS)
    rows = f"(SELECT m, p, x0 AS z0, x1 AS z1, x2 + x3 AS z2 FROM {fit.weighted(fit.beta)})"
    pairs = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, sum(m * p * (1 - p) * z{i} * z{j}) / sum(m) AS value FROM {rows}"
        for i in range(3)
        for j in range(i, 3)
    )
    return f"{fit.with_clause()} {pairs}"


@bind(_gram_sql(), ["value"], digits=5)
def m14_gram_matrix(t: Tables):
    train = _lines(t)
    fitted = fit_logistic(train, NUMERIC, CATEGORICAL, COSTLY)
    return gram_matrix(fitted, train).select("i", "j", (F.col("value") / fitted.design.rows).alias("value"))


def _coefficient_sql() -> str:
    fit = NewtonSql(WHOLE_MODEL, NUMERIC, STATUS)
    inverse = fit.invert()
    w = fit.width
    named = [("l_quantity", 1, "TRUE")] + [(f"l_linestatus_{v}", i + 2, f"ref0 <> '{v}'") for i, (_, v) in enumerate(fit.dummies)]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS name, b{k} AS coef, sqrt(a{k}_{w + k}) AS se FROM {inverse} JOIN facts USING (g) WHERE {condition}"
        for name, k, condition in named
    )
    return f"""{fit.with_clause()} SELECT name, coef, se, exp(coef) AS odds_ratio, exp(coef - 1.959963984540054 * se) AS or_low,
        exp(coef + 1.959963984540054 * se) AS or_high FROM ({rows})"""


COEFFICIENTS = ["coef", "se", "odds_ratio", "or_low", "or_high"]


@bind(_coefficient_sql(), COEFFICIENTS, digits=4)
def m14_coefficient_stats(t: Tables):
    train = _lines(t)
    fitted = fit_logistic(train, NUMERIC, CATEGORICAL, COSTLY)
    return coefficient_stats(fitted, train).select("name", *COEFFICIENTS)


# log odds of each level against the reference: coefficients that SQL can give without a fit
LOG_ODDS_SQL = """
    WITH c AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS level, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS k FROM orders GROUP BY 2),
         r AS (SELECT * FROM c ORDER BY n DESC, level LIMIT 1)
    SELECT c.feature, c.level, c.feature || '_' || c.level AS name, ln(c.k / (c.n - c.k)) - ln(r.k / (r.n - r.k)) AS coef, r.level AS ref, c.n, r.n AS n_reference
    FROM c, r WHERE c.level <> r.level
"""


def _log_odds(t: Tables):
    rates = outcome_rate(t.orders, ["o_orderpriority"], Outcome("o_orderstatus", "F")).filter("kind = 'level'")
    odds = rates.select("column", "level", F.log(F.col("positives") / (F.col("n") - F.col("positives"))).alias("odds"))
    base = odds.join(reference_levels(t.orders, ["o_orderpriority"]).select("column", F.col("level").alias("ref")), "column")
    zero = F.max(F.when(F.col("level") == F.col("ref"), F.col("odds")))
    zero = base.groupBy("column").agg(zero.alias("zero"))
    return (
        base.join(zero, "column")
        .filter("level <> ref")
        .select(
            F.col("column").alias("feature"), "level", F.concat_ws("_", "column", "level").alias("name"), (F.col("odds") - F.col("zero")).alias("coef")
        )
    )


@bind(
    f"""
    SELECT feature, level, name, coef, feature || '=' || ref AS contrast, n, n_reference FROM ({LOG_ODDS_SQL})
    UNION ALL SELECT 'o_totalprice', '', 'o_totalprice', corr(o_totalprice, o_custkey), '1 SD', count(*), -1 FROM orders
    """,
    ["coef"],
)
def m15_annotate_coefficients(t: Tables):
    number = t.orders.agg(F.corr("o_totalprice", "o_custkey").alias("coef"), F.count(F.lit(1)).alias("rows"))
    coefs = _log_odds(t).unionByName(
        number.select(F.lit("o_totalprice").alias("feature"), F.lit(None).cast("string").alias("level"), F.lit("o_totalprice").alias("name"), "coef")
    )
    columns = ["o_orderpriority"]
    noted = annotate_coefficients(coefs, level_counts(t.orders, columns), reference_levels(t.orders, columns), t.orders.count())
    return noted.withColumn("level", F.coalesce("level", F.lit(""))).withColumn("n_reference", F.coalesce("n_reference", F.lit(-1)))


def _fit_score_sql() -> str:
    fit = NewtonSql(ONE_MODEL, NUMERIC, STATUS)
    test = f"({fit.with_clause()} SELECT label, score FROM {_scored_sql(fit, TEST_ROWS)})"
    return f"""
    WITH tested AS MATERIALIZED {test}
    SELECT (SELECT count(*) FROM {LINES} WHERE {TRAIN}) AS train_rows, (SELECT count(*) FROM tested) AS test_rows,
           (SELECT avg(y) FROM {LINES} WHERE {TRAIN}) AS train_positive_rate, (SELECT avg(label) FROM tested) AS test_positive_rate, *
    FROM ({metrics_sql("tested")})
    """


SIZES = ["train_positive_rate", "test_positive_rate"]


@bind(_fit_score_sql(), [*SIZES, *ALL_METRICS], digits=5)
def m16_fit_score(t: Tables):
    train, test = _split(t)
    return fit_score(train, test, NUMERIC, CATEGORICAL, COSTLY)[1].drop("threshold")


# a status that is missing for some lines: dropped, or kept as a level of its own
HIDDEN = f"(SELECT *, CASE WHEN l_linenumber <> 4 OR l_quantity > 30 THEN l_linestatus END AS status FROM {LINES})"


def _strategy_sql() -> str:
    rows = f"""
        SELECT 'drop' AS g, y, l_quantity, status FROM {HIDDEN} WHERE {TRAIN} AND status IS NOT NULL
        UNION ALL SELECT 'unknown', y, l_quantity, coalesce(status, 'Unknown') FROM {HIDDEN} WHERE {TRAIN}
    """
    fit = NewtonSql(rows, NUMERIC, {"status": ["F", "O", "Unknown"]})
    test = f"(SELECT s.g, y AS label, l_quantity, status FROM {HIDDEN}, (SELECT DISTINCT g FROM sc) s WHERE {TEST} AND status IS NOT NULL)"
    scored = f"({fit.with_clause()} SELECT g, label, score FROM {_scored_sql(fit, test)})"
    sizes = f"(SELECT g, count(*) AS train_rows FROM ({rows}) GROUP BY g)"
    each = " UNION ALL ".join(
        f"SELECT '{g}' AS strategy, (SELECT train_rows FROM {sizes} WHERE g = '{g}') AS train_rows, * FROM ({metrics_sql(f'''(SELECT * FROM tested WHERE g = '{g}')''')})"
        for g in ("drop", "unknown")
    )
    return f"WITH tested AS MATERIALIZED {scored} SELECT *, tn + fp + fn + tp AS test_rows FROM ({each})"


def _strategies(t: Tables):
    shown = (F.col("l_linenumber") != 4) | (F.col("l_quantity") > 30)
    hidden = _lines(t).withColumn("status", F.when(shown, F.col("l_linestatus")))
    train, test = hidden.filter("l_orderkey % 3 <> 0"), hidden.filter("l_orderkey % 3 = 0").na.drop()
    trains = {"drop": train.na.drop(), "unknown": fill_unknown(train, ["status"])}
    return compare_strategies(trains, test, NUMERIC, ["status"], COSTLY)


@bind(_strategy_sql(), ALL_METRICS, digits=4)
def m17_compare_strategies(t: Tables):
    return _strategies(t).drop("threshold", *SIZES)


@bind(
    f"""
    SELECT count(*) AS strategies, max(f1) AS best_f1, min(f1) AS worst_f1, max(f1) - min(f1) AS gap,
           CAST(count(*) > 1 AND max(f1) - min(f1) < 0.01 AS BIGINT) AS tie,
           CASE WHEN max(f1) - min(f1) < 0.01 THEN '' ELSE arg_max(strategy, f1) END AS winner,
           CASE WHEN max(f1) - min(f1) < 0.01 THEN 'no ranking' ELSE 'best: ' || arg_max(strategy, f1) END AS verdict
    FROM ({_strategy_sql()})
    """,
    ["best_f1", "worst_f1", "gap"],
    digits=4,
)
def m18_strategy_verdict(t: Tables):
    return strategy_verdict(_strategies(t)).withColumn("winner", F.coalesce("winner", F.lit("")))


@bind(
    """
    SELECT count(*) AS strategies, max(f1) AS best_f1, min(f1) AS worst_f1, max(f1) - min(f1) AS gap, CAST(max(f1) - min(f1) < 0.01 AS BIGINT) AS tie,
           CASE WHEN max(f1) - min(f1) < 0.01 THEN '' ELSE arg_max(strategy, f1) END AS winner
    FROM (SELECT o_orderpriority AS strategy, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS f1 FROM orders GROUP BY 1)
    """,
    ["best_f1", "worst_f1", "gap"],
)
def m18_verdict_over_rates(t: Tables):
    rates = outcome_rate(t.orders, ["o_orderpriority"], Outcome("o_orderstatus", "F")).filter("kind = 'level'")
    verdict = strategy_verdict(rates.select(F.col("level").alias("strategy"), F.col("ratio").alias("f1")))
    return verdict.withColumn("winner", F.coalesce("winner", F.lit(""))).drop("verdict")


def _sensitivity_sql() -> str:
    with_flag = f"SELECT 1 AS g, y, l_quantity, l_linestatus FROM {LINES} WHERE {TRAIN}"
    fit = NewtonSql(with_flag, NUMERIC, STATUS)
    inverse = fit.invert()
    w = fit.width
    rows = " UNION ALL ".join(
        f"SELECT 'l_linestatus_{v}' AS name, ref0 AS reference, b{i + 2} AS coef, sqrt(a{i + 2}_{w + i + 2}) AS se FROM {inverse} JOIN facts USING (g) WHERE ref0 <> '{v}'"
        for i, (_, v) in enumerate(fit.dummies)
    )
    scored = f"(SELECT label, score FROM {_scored_sql(fit, TEST_ROWS)})"
    return f"""{fit.with_clause()}
    SELECT 'l_returnflag' AS excluded, name, reference, coef, se, exp(coef) AS odds_ratio, accuracy, f1 FROM ({rows}), ({metrics_sql(scored)})
    """


@bind(_sensitivity_sql(), ["coef", "se", "odds_ratio", "accuracy", "f1"], digits=4)
def m19_sensitivity(t: Tables):
    train, test = _split(t)
    found = sensitivity(train, test, NUMERIC, ["l_linestatus", "l_returnflag"], COSTLY, excluded="l_returnflag", focus="l_linestatus")
    return found.select("excluded", "name", "reference", "coef", "se", "odds_ratio", "accuracy", "f1")


@bind(f"SELECT feature, level, name, coef FROM ({LOG_ODDS_SQL}) ORDER BY abs(coef) DESC, name LIMIT 1", ["coef"])
def m20_strongest(t: Tables):
    return strongest(_log_odds(t))


@bind("SELECT count(*) AS \"rows\", CAST(0 AS BIGINT) AS mismatches FROM lineitem")
def s4_save_and_verify(t: Tables):
    lines = _lines(t)
    fitted = fit_logistic(lines, NUMERIC, CATEGORICAL, COSTLY)
    return save_and_verify(fitted.model, lines, new_path(t.spark, "model"))
