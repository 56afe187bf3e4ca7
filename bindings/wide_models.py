"""Encoding and models over columns of many levels; fits are checked against Newton steps that eliminate the levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.newton import LevelNewtonSql
from bindings.registry import Tables, bind
from outcome_lens.contract import Outcome
from outcome_lens.operators.design import fit_encoder
from outcome_lens.operators.wide import fit_wide, wide_coefficient_stats, wide_coefficients, wide_score

FILLED = Outcome("o_orderstatus", "F")
COSTLY = Outcome("cost", "high")
BY_CUSTOMER = "SELECT CAST(o_orderstatus = 'F' AS INT) AS y, o_totalprice AS x, CAST(o_custkey AS VARCHAR) AS level FROM orders"
BY_ORDER = "SELECT CAST(l_quantity * l_discount > 1.2 AS INT) AS y, l_quantity AS x, CAST(l_orderkey AS VARCHAR) AS level FROM lineitem"
ASKED = [1, 2, 3, 5, 7]


@bind(
    """
    WITH c AS (SELECT CAST(o_custkey AS VARCHAR) AS level, count(*) AS n FROM orders GROUP BY 1),
         r AS (SELECT level AS ref FROM c ORDER BY n DESC, level LIMIT 1)
    SELECT 'o_custkey' AS "column", level, n, row_number() OVER (ORDER BY level <> ref, level) - 1 AS slot, CAST(level = ref AS BIGINT) AS is_reference FROM c, r
    """
)
def m2_encoder_many_levels(t: Tables):
    return fit_encoder(t.orders, ["o_custkey"])


def _customers_sql() -> str:
    fit = LevelNewtonSql(BY_CUSTOMER)
    return f"{fit.with_clause()} SELECT level, coef FROM {fit.coefficients()}"


@bind(_customers_sql(), ["coef"], digits=4)
def m4_fit_many_levels(t: Tables):
    fitted = fit_wide(t.orders, ["o_totalprice"], ["o_custkey"], FILLED)
    return wide_coefficients(fitted).select(F.coalesce("level", F.lit("")).alias("level"), "coef")


def _scores_sql() -> str:
    fit = LevelNewtonSql(BY_CUSTOMER)
    return f"{fit.with_clause()} SELECT level AS customer, count(*) AS n, avg(p) AS score, CAST(sum(y) AS BIGINT) AS positives FROM p{fit.last} WHERE level IS NOT NULL GROUP BY 1"


@bind(_scores_sql(), ["score"], digits=4)
def m5_score_many_levels(t: Tables):
    fitted = fit_wide(t.orders, ["o_totalprice"], ["o_custkey"], FILLED)
    reference = fitted.design.levels.filter("is_reference").first().level
    scored = wide_score(fitted, t.orders).groupBy(F.col("o_custkey").cast("string").alias("customer"))
    means = scored.agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("score"), F.sum("label").alias("positives"))
    return means.filter(F.col("customer") != reference)


def _orders_sql() -> str:
    fit = LevelNewtonSql(BY_ORDER)
    names = ", ".join(f"'{k}'" for k in ["", *ASKED])
    return f"""{fit.with_clause()} SELECT level, coef, se, exp(coef) AS odds_ratio, exp(coef - 1.959963984540054 * se) AS or_low,
        exp(coef + 1.959963984540054 * se) AS or_high FROM {fit.coefficients()} WHERE level IN ({names})"""


@bind(_orders_sql(), ["coef", "se", "odds_ratio", "or_low", "or_high"], digits=3)
def m14_many_columns(t: Tables):
    lines = t.lineitem.withColumn("cost", F.when(F.col("l_quantity") * F.col("l_discount") > 1.2, "high").otherwise("low"))
    fitted = fit_wide(lines, ["l_quantity"], ["l_orderkey"], COSTLY)
    keys = [str(k) for k in ASKED]
    found = fitted.design.levels.filter(F.col("level").isin(keys) & ~F.col("is_reference")).select("level").collect()
    stats = wide_coefficient_stats(fitted, [("l_quantity", None), *[("l_orderkey", r.level) for r in found]])
    return stats.select(F.coalesce("level", F.lit("")).alias("level"), "coef", "se", "odds_ratio", "or_low", "or_high")
