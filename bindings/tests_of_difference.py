"""Hypothesis tests; p values are checked against integrals of the densities in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import Tables, bind
from outcome_lens.contract import Outcome
from outcome_lens.operators.hypothesis import chi_square, welch_t
from outcome_lens.operators.rates import outcome_rate
from outcome_lens.plans.conclusions import conclusions


def welch_sql(value: str, group: str, a: str, b: str, table: str, by: str = "") -> str:
    """Welch's t and Cohen's d from moments; p by Simpson's rule, the t quantile by its expansion."""
    keep, grouped = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
    WITH m AS (SELECT {keep} count({value}) FILTER (WHERE {group} = '{a}') AS n_a, count({value}) FILTER (WHERE {group} = '{b}') AS n_b,
                      avg({value}) FILTER (WHERE {group} = '{a}') AS mean_a, avg({value}) FILTER (WHERE {group} = '{b}') AS mean_b,
                      var_samp({value}) FILTER (WHERE {group} = '{a}') AS v_a, var_samp({value}) FILTER (WHERE {group} = '{b}') AS v_b
               FROM {table} {grouped}),
         s AS (SELECT *, mean_a - mean_b AS diff, sqrt(v_a / n_a + v_b / n_b) AS se,
                      pow(v_a / n_a + v_b / n_b, 2) / (pow(v_a / n_a, 2) / (n_a - 1) + pow(v_b / n_b, 2) / (n_b - 1)) AS dof,
                      (mean_a - mean_b) / sqrt(((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2)) AS cohens_d FROM m),
         t AS (SELECT *, diff / se AS t, lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi()) AS log_c FROM s),
         i AS (SELECT range AS k FROM range(2001)),
         p AS (SELECT {keep} n_a, n_b, mean_a, mean_b, diff, se, t, dof, cohens_d,
                      1 - 2 * sum(CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
                                  * exp(log_c - (dof + 1) / 2 * ln(1 + pow(abs(t) * k / 2000, 2) / dof))) * abs(t) / 6000 AS p
               FROM t, i GROUP BY {keep} n_a, n_b, mean_a, mean_b, diff, se, t, dof, cohens_d),
         c AS (SELECT *, 1.959963984540054 AS z FROM p),
         q AS (SELECT *, z + (pow(z, 3) + z) / (4 * dof) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * dof * dof)
                          + (3 * pow(z, 7) + 19 * pow(z, 5) + 17 * pow(z, 3) - 15 * z) / (384 * pow(dof, 3)) AS t_crit FROM c)
    SELECT {keep} n_a, n_b, mean_a, mean_b, diff, t, dof, cohens_d, p, diff - t_crit * se AS ci_low, diff + t_crit * se AS ci_high,
           CASE WHEN abs(cohens_d) < 0.2 THEN 'very small' WHEN abs(cohens_d) < 0.5 THEN 'small'
                WHEN abs(cohens_d) < 0.8 THEN 'medium' ELSE 'large' END AS effect,
           CAST(p = 0 AS BIGINT) AS p_underflow, CAST(p < 0.05 AS BIGINT) AS significant
    FROM q
    """


WELCH_DOUBLES = ["mean_a", "mean_b", "diff", "t", "dof", "cohens_d", "p", "ci_low", "ci_high"]
WELCH_SHOWN = ["n_a", "n_b", *WELCH_DOUBLES, "effect", "p_underflow", "significant"]


@bind(welch_sql("l_extendedprice", "l_linestatus", "O", "F", "lineitem"), WELCH_DOUBLES, digits=5)
def t1_welch_t(t: Tables):
    return welch_t(t.lineitem, "l_extendedprice", "l_linestatus", "O", "F").select(*WELCH_SHOWN)


@bind(welch_sql("l_extendedprice", "l_linestatus", "O", "F", "lineitem", "l_returnflag"), WELCH_DOUBLES, digits=5)
def t1_welch_t_by_segment(t: Tables):
    tested = welch_t(t.lineitem, "l_extendedprice", "l_linestatus", "O", "F", by=["l_returnflag"])
    return tested.select("l_returnflag", *WELCH_SHOWN)


GRADED = "(SELECT n_chars, CAST(quality AS VARCHAR) AS quality FROM documents JOIN labels USING (doc_id))"
NO_INTERVAL = [c for c in WELCH_DOUBLES if not c.startswith("ci_")]


@bind(f"SELECT * EXCLUDE (ci_low, ci_high) FROM ({welch_sql('n_chars', 'quality', '1', '0', GRADED)})", NO_INTERVAL)
def t2_cohens_d(t: Tables):
    tested = welch_t(t.documents.join(t.labels, "doc_id"), "n_chars", "quality", 1, 0)
    return tested.select(*[c for c in WELCH_SHOWN if not c.startswith("ci_")])


def chi_sql(a: str, b: str, table: str, by: str = "") -> str:
    """The statistic over the full grid of levels; p by the closed form for an even dof."""
    keep, cond, = (f"{by} AS s", "TRUE") if by else ("1 AS s", "TRUE")
    return f"""
    WITH d AS (SELECT {keep}, {a} AS a, {b} AS b FROM {table} WHERE {cond}),
         r AS (SELECT s, a, count(*) AS x FROM d GROUP BY s, a), c AS (SELECT s, b, count(*) AS y FROM d GROUP BY s, b),
         n AS (SELECT s, count(*) AS n FROM d GROUP BY s), o AS (SELECT s, a, b, count(*) AS o FROM d GROUP BY s, a, b),
         g AS (SELECT r.s, r.a, c.b, coalesce(o, 0) AS o, CAST(x AS DOUBLE) * y / n AS e, n FROM r JOIN c ON r.s = c.s JOIN n ON n.s = r.s
               LEFT JOIN o ON o.s = r.s AND o.a = r.a AND o.b = c.b),
         t AS (SELECT s, sum(pow(o - e, 2) / e) AS chi2, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof, any_value(n) AS n,
                      min(e) AS expected_min, least(count(DISTINCT a), count(DISTINCT b)) - 1 AS k FROM g GROUP BY s),
         p AS (SELECT t.*, (SELECT exp(-chi2 / 2) * sum(pow(chi2 / 2, range) / gamma(range + 1.0)) FROM range(100) WHERE range < dof / 2) AS p FROM t)
    SELECT {"s AS " + by + "," if by else ""} chi2, dof, n, expected_min, sqrt(chi2 / (n * k)) AS cramers_v, p,
           CAST(p < 0.05 AS BIGINT) AS significant FROM p
    """


CHI_DOUBLES = ["chi2", "expected_min", "cramers_v", "p"]
CHI_SHOWN = ["chi2", "dof", "n", "expected_min", "cramers_v", "p", "significant"]


@bind(chi_sql("o_orderstatus", "o_orderpriority", "orders"), CHI_DOUBLES)
def t3_chi_square(t: Tables):
    return chi_square(t.orders, "o_orderstatus", "o_orderpriority").select(*CHI_SHOWN)


@bind(chi_sql("l_linestatus", "l_linenumber", "lineitem", "l_returnflag"), CHI_DOUBLES)
def t3_chi_square_by_segment(t: Tables):
    tested = chi_square(t.lineitem, "l_linestatus", "l_linenumber", by=["l_returnflag"])
    return tested.select("l_returnflag", *CHI_SHOWN)


@bind(chi_sql("o_orderstatus", "o_orderpriority", "(SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority) FROM orders)"), CHI_DOUBLES)
def t4_cramers_v_with_empty_cell(t: Tables):
    raised = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH"), "1-URGENT").otherwise(F.col("o_orderpriority"))
    return chi_square(t.orders.withColumn("o_orderpriority", raised), "o_orderstatus", "o_orderpriority").select(*CHI_SHOWN)


@bind(
    """
    SELECT o_orderpriority AS level, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS ratio
    FROM orders GROUP BY o_orderpriority
    """,
    ["ratio"],
)
def t5_rate_by_factor(t: Tables):
    rates = outcome_rate(t.orders, ["o_orderpriority"], Outcome("o_orderstatus", "F"))
    return rates.filter(F.col("kind") == "level").select("level", "n", "ratio")


def facts_sql(welch: str, chi: str, rates: str) -> str:
    """The conclusions that need no model, from the SQL of the tests."""
    return f"""
    SELECT 'independence' AS fact, '' AS item, cramers_v AS value, 0.0 AS low, 0.0 AS high,
           CASE WHEN significant = 1 THEN 'dependent' ELSE 'independence not rejected' END AS verdict FROM ({chi})
    UNION ALL SELECT 'mean difference', '', diff, ci_low, ci_high, CASE WHEN significant = 1 THEN 'different' ELSE 'no difference shown' END FROM ({welch})
    UNION ALL SELECT 'effect size', '', cohens_d, 0, 0, effect FROM ({welch})
    UNION ALL SELECT 'outcome rate', item, ratio, 0, 0, '' FROM ({rates})
    """


def shown(facts):
    return facts.select(
        "fact", "item", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("value", "low", "high")], F.coalesce("verdict", F.lit("")).alias("verdict")
    )


@bind(
    facts_sql(
        welch_sql("l_extendedprice", "l_linestatus", "O", "F", "lineitem"),
        chi_sql("l_returnflag", "l_linenumber", "lineitem"),
        """SELECT 'l_returnflag=' || l_returnflag AS item, avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END) AS ratio FROM lineitem GROUP BY l_returnflag""",
    ),
    ["value", "low", "high"],
    digits=5,
)
def m21_conclusions(t: Tables):
    return shown(
        conclusions(
            chi_square=chi_square(t.lineitem, "l_returnflag", "l_linenumber"),
            welch=welch_t(t.lineitem, "l_extendedprice", "l_linestatus", "O", "F"),
            rates=outcome_rate(t.lineitem, ["l_returnflag"], Outcome("l_linestatus", "O")),
        )
    )
