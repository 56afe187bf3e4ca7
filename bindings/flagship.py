"""The whole report over the order lines, checked fact by fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from bindings.models import NewtonSql, metrics_sql
from bindings.registry import Tables, bind
from bindings.scores import best_sql
from bindings.tests_of_difference import facts_sql, shown, welch_sql
from outcome_lens.contract import Outcome
from outcome_lens.plans.outcome_report import ReportSpec, outcome_report


def spec() -> ReportSpec:
    return ReportSpec(
        outcome=Outcome("cost", "high"),
        negative="low",
        numeric=("l_quantity",),
        categorical=("status", "l_returnflag"),
        compared="l_quantity",
        factor="status",
        excluded="l_returnflag",
        fold=F.col("l_orderkey") % 5,
        caps={"l_quantity": 50.0},
    )


LINES = """
    (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linenumber <> 4 OR l_quantity > 30 THEN l_linestatus END AS status, l_returnflag,
            CASE WHEN l_quantity * l_discount > 1.2 THEN 'high' ELSE 'low' END AS cost, CAST(l_quantity * l_discount > 1.2 AS INT) AS y
     FROM lineitem)
"""


def _lines(t: Tables):
    shown_status = (F.col("l_linenumber") != 4) | (F.col("l_quantity") > 30)
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(shown_status, F.col("l_linestatus")).alias("status"),
        "l_returnflag",
        F.when(F.col("l_quantity") * F.col("l_discount") > 1.2, "high").otherwise("low").alias("cost"),
    )


def report(t: Tables):
    lines = _lines(t)
    return outcome_report(
        lines.filter("l_orderkey % 3 <> 0"), lines.filter("l_orderkey % 3 = 0"), spec(), tables=["facts"]
    )


TRAIN = f"(SELECT DISTINCT * FROM {LINES} WHERE l_orderkey % 3 <> 0 AND status IS NOT NULL)"
TEST = f"(SELECT DISTINCT * FROM {LINES} WHERE l_orderkey % 3 = 0 AND status IS NOT NULL)"
REFERENCES = " UNION ALL ".join(
    f"""(SELECT '{c}' AS "column", {c} AS level, count(*) AS n FROM {TRAIN} GROUP BY {c} ORDER BY n DESC, level LIMIT 1)""" for c in ("status", "l_returnflag")
)
UNKNOWN = f"(SELECT DISTINCT * REPLACE (coalesce(status, 'Unknown') AS status) FROM {LINES} WHERE l_orderkey % 3 <> 0)"
STATUS = ["F", "O", "Unknown"]
FLAGS = ["A", "N", "R"]


def _odds(fit: NewtonSql, condition: str = "TRUE") -> str:
    inverse, w = fit.invert(), fit.width
    names = [("l_quantity", 1, "TRUE")]
    for i, (column, level) in enumerate(fit.dummies):
        at = list(fit.levels).index(column)
        present = f"ref{at} <> '{level}'" + (" AND FALSE" if level == "Unknown" else "")
        names.append((f"{column}_{level}", i + 2, present))
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS name, b{k} AS coef, sqrt(a{k}_{w + k}) AS se FROM {inverse} JOIN facts USING (g) WHERE {present}"
        for name, k, present in names
    )
    return f"""({fit.with_clause()} SELECT name, coef, exp(coef) AS value, exp(coef - 1.959963984540054 * se) AS low, exp(coef + 1.959963984540054 * se) AS high,
        CASE WHEN exp(coef - 1.959963984540054 * se) <= 1 AND exp(coef + 1.959963984540054 * se) >= 1 THEN 'direction open'
             WHEN exp(coef) > 1 THEN 'raises the odds' ELSE 'lowers the odds' END AS verdict FROM ({rows}) WHERE {condition})"""


def _scored(rows: str, levels: dict, score_rows: str) -> str:
    fit = NewtonSql(rows, ["l_quantity"], levels)
    return f"({fit.with_clause()} SELECT g, y AS label, {fit.probability()} AS score FROM {score_rows} r JOIN {fit.beta} USING (g) JOIN facts USING (g))"


def _report_sql() -> str:
    both = {"status": STATUS, "l_returnflag": FLAGS}
    one = f"SELECT 1 AS g, * FROM {TRAIN}"
    full = NewtonSql(one, ["l_quantity"], both)
    less = NewtonSql(one, ["l_quantity"], {"status": STATUS})
    held = _scored(
        f"SELECT f.range AS g, t.* FROM {TRAIN} t, range(5) f WHERE l_orderkey % 5 <> f.range",
        both,
        f"(SELECT l_orderkey % 5 AS g, * FROM {TRAIN})",
    )
    tested = _scored(f"SELECT 0 AS g, * FROM {TRAIN} UNION ALL SELECT 1, * FROM {UNKNOWN}", both, f"(SELECT s.range AS g, t.* FROM {TEST} t, range(2) s)")
    chi = f"""
        SELECT sqrt(chi2 / n) AS cramers_v, CAST(chi2 > 3.841458820694124 AS BIGINT) AS significant
        FROM (SELECT sum(pow(o - e, 2) / e) AS chi2, sum(o) AS n FROM (
          SELECT count(*) AS o, any_value(x) * any_value(y2) / any_value(n) AS e
          FROM (SELECT status, cost, count(*) OVER (PARTITION BY status) * 1.0 AS x, count(*) OVER (PARTITION BY cost) AS y2, count(*) OVER () AS n FROM {TRAIN})
          GROUP BY status, cost))
    """
    facts = facts_sql(
        welch_sql("l_quantity", "cost", "high", "low", TRAIN),
        chi,
        f"SELECT 'status=' || status AS item, avg(y) AS ratio FROM {TRAIN} GROUP BY status",
    )
    at_half = metrics_sql("(SELECT label, score FROM tested WHERE g = 0)")
    at_best = metrics_sql("(SELECT label, score FROM tested WHERE g = 0)", "(SELECT threshold FROM best)")
    unknown = metrics_sql("(SELECT label, score FROM tested WHERE g = 1)")
    return f"""
    WITH held AS MATERIALIZED {held}, tested AS MATERIALIZED {tested}, best AS MATERIALIZED ({best_sql("(SELECT label, score FROM held)")}),
         odds AS MATERIALIZED {_odds(full)}, without AS MATERIALIZED {_odds(less)},
         thresholds AS MATERIALIZED (SELECT 'default' AS kind, fn, recall, f1 FROM ({at_half}) UNION ALL SELECT 'tuned', fn, recall, f1 FROM ({at_best})),
         strategies AS MATERIALIZED (SELECT 'drop' AS strategy, f1 FROM ({at_half}) UNION ALL SELECT 'unknown', f1 FROM ({unknown}))
    SELECT * FROM ({facts})
    UNION ALL SELECT * FROM (SELECT 'strongest term', name, value, low, high, verdict FROM odds ORDER BY abs(coef) DESC LIMIT 1)
    UNION ALL SELECT 'focus term', name, value, low, high, verdict FROM odds WHERE name LIKE 'status%'
    UNION ALL SELECT 'sensitivity', name || ' without l_returnflag', value, low, high, verdict FROM without WHERE name LIKE 'status%'
    UNION ALL SELECT 'missed positives', kind, fn, 0, 0, '' FROM thresholds
    UNION ALL SELECT 'recall', kind, recall, 0, 0, '' FROM thresholds
    UNION ALL SELECT 'tuned threshold', '', threshold, 0, 0, '' FROM best
    UNION ALL SELECT 'change in missed positives', '', d, 0, 0, CASE WHEN d < 0 THEN 'fewer missed' WHEN d > 0 THEN 'more missed' ELSE 'same' END
              FROM (SELECT sum(CASE WHEN kind = 'tuned' THEN fn ELSE -fn END) AS d FROM thresholds)
    UNION ALL SELECT 'strategy gap', '', max(f1) - min(f1), 0, 0,
              CASE WHEN max(f1) - min(f1) < 0.01 THEN 'no ranking' ELSE 'best: ' || arg_max(strategy, f1) END FROM strategies
    UNION ALL SELECT 'reference', "column", n, 0, 0, level FROM ({REFERENCES})
    UNION ALL SELECT 'focus contrast', 'status: ' || substr(name, 8) || ' against ' || (SELECT level FROM ({REFERENCES}) WHERE "column" = 'status'), value, low, high, verdict
              FROM odds WHERE name LIKE 'status%'
    """


@bind(_report_sql(), ["value", "low", "high"], digits=4)
def flagship_outcome_report(t: Tables):
    return shown(report(t)["facts"])


# every table of the report, and the numbers of some of them: item, measure and value of each row
LISTED = {
    "describe": ("column", ("count", "mean", "std", "min", "q25", "q50", "q75", "max")),
    "references": ("column", ("n", "levels")),
    "scales": ("column", ("n", "mean", "sd_pop", "scale")),
    "crosstab": ("a || '/' || b", ("observed", "expected")),
    "box": ("group", ("n", "mean", "whisker_low", "q1", "median", "q3", "whisker_high")),
    "overlap": ("'all'", ("pair_rows", "distinct_rows", "test_rows_hit")),
}


def _listed_sql() -> str:
    """One row a number; ``{{m}}`` stands for the measures of a table."""
    x = "l_quantity"
    quartiles = ", ".join(f"quantile_cont({x}, {p}) AS {q}" for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    box = f"SELECT cost, count(*) AS n, avg({x}) AS mean, quantile_cont({x}, 0.25) AS q1, median({x}) AS median, quantile_cont({x}, 0.75) AS q3 FROM {TRAIN} GROUP BY cost"
    parts = {
        "describe": f"SELECT '{x}' AS item, count(*) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS min, {quartiles}, max({x}) AS max FROM {TRAIN}",
        "references": f"""SELECT r."column" AS item, r.n, CASE r."column" WHEN 'status' THEN (SELECT count(DISTINCT status) FROM {TRAIN})
            ELSE (SELECT count(DISTINCT l_returnflag) FROM {TRAIN}) END AS levels FROM ({REFERENCES}) r""",
        "scales": f"SELECT '{x}' AS item, count(*) AS n, avg({x}) AS mean, stddev_pop({x}) AS sd_pop, stddev_pop({x}) AS scale FROM {TRAIN}",
        "crosstab": f"""SELECT status || '/' || cost AS item, count(*) AS observed, any_value(r) * any_value(c) / any_value(n) AS expected FROM
            (SELECT status, cost, count(*) OVER (PARTITION BY status) * 1.0 AS r, count(*) OVER (PARTITION BY cost) AS c, count(*) OVER () AS n FROM {TRAIN}) GROUP BY status, cost""",
        "box": f"""SELECT b.cost AS item, any_value(n) AS n, any_value(mean) AS mean, min({x}) AS whisker_low, any_value(q1) AS q1, any_value(median) AS median,
            any_value(q3) AS q3, max({x}) AS whisker_high FROM ({box}) b JOIN {TRAIN} t ON t.cost = b.cost AND {x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY b.cost""",
        "overlap": "SELECT 'all' AS item, 0 AS pair_rows, 0 AS distinct_rows, 0 AS test_rows_hit",
    }
    rows = [
        f"SELECT '{table}' AS report_table, item, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({sql})" for table, sql in parts.items() for m in LISTED[table][1]
    ]
    return " UNION ALL ".join(rows)


@bind(_listed_sql(), ["value"])
def flagship_report_tables(t: Tables):
    """All tables of the report are built; those that are listed come as one table of numbers."""
    lines = _lines(t)
    tables = outcome_report(lines.filter("l_orderkey % 3 <> 0"), lines.filter("l_orderkey % 3 = 0"), spec())
    assert set(LISTED) < set(tables)
    for name in set(tables) - set(LISTED):
        tables[name].write.format("noop").mode("overwrite").save()
    long = []
    for name, (item, measures) in LISTED.items():
        entries = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("e")
        label = F.expr(item) if "'" in item else F.col(item)
        long.append(tables[name].select(F.lit(name).alias("report_table"), label.alias("item"), entries).select("report_table", "item", "e.*"))
    return reduce(lambda a, b: a.unionByName(b), long)
