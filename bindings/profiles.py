"""Profiles of columns, and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import Tables, bind
from outcome_lens.contract import Outcome
from outcome_lens.functions.formats import effect_label, p_text
from outcome_lens.operators.describe import correlation, describe_all, describe_numeric, top_bottom
from outcome_lens.operators.distributions import box_stats, histogram, shape_profile
from outcome_lens.operators.levels import crosstab, level_counts, reference_levels
from outcome_lens.operators.rates import fold_rare, outcome_rate, rank_levels

RETURNED = Outcome("l_returnflag", "R")
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@bind(
    """
    SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS BIGINT) AS returned,
           CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_returnflag = 'R' AS BIGINT) END AS returned_if_known
    FROM lineitem
    """
)
def p1_binary_target(t: Tables):
    known = F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("known")
    return t.lineitem.select("*", known).select(
        "l_orderkey",
        "l_linenumber",
        RETURNED.flag().alias("returned"),
        Outcome("known", "R").flag().alias("returned_if_known"),
    )


@bind(
    """
    SELECT p_partkey,
           CASE WHEN p_partkey % 10 = 0 THEN 'below 1e-308'
                WHEN 1.0 / ((p_partkey * 7 + 3) * (p_partkey + 1)) < 1e-4
                THEN printf('%.3e', CAST(1.0 AS DOUBLE) / ((p_partkey * 7 + 3) * (p_partkey + 1)))
                ELSE printf('%.6f', CAST(1.0 AS DOUBLE) / ((p_partkey * 7 + 3) * (p_partkey + 1))) END AS p_text,
           CASE WHEN abs(p_size - 25) < 5 THEN 'very small' WHEN abs(p_size - 25) < 12.5 THEN 'small'
                WHEN abs(p_size - 25) < 20 THEN 'medium' ELSE 'large' END AS effect
    FROM part
    """
)
def p7_result_texts(t: Tables):
    p = F.when(F.col("p_partkey") % 10 == 0, 0.0).otherwise(
        F.lit(1.0) / ((F.col("p_partkey") * 7 + 3) * (F.col("p_partkey") + 1))
    )
    return t.part.select(
        "p_partkey", p_text(p).alias("p_text"), effect_label((F.col("p_size") - 25) / 25.0).alias("effect")
    )


def _describe_sql(name: str) -> str:
    return f"""
    SELECT '{name}' AS "column", count({name}) AS count, avg({name}) AS mean, stddev_samp({name}) AS std, min({name}) AS min,
           quantile_cont({name}, 0.25) AS q25, quantile_cont({name}, 0.5) AS q50, quantile_cont({name}, 0.75) AS q75,
           max({name}) AS max FROM lineitem
    """


@bind(" UNION ALL ".join(_describe_sql(m) for m in MEASURES), ["mean", "std", "min", "q25", "q50", "q75", "max"])
def a1_describe_numeric(t: Tables):
    return describe_numeric(t.lineitem, MEASURES)


def _describe_all_sql(name: str) -> str:
    return f"""
    SELECT '{name}' AS "column", count({name}) AS count, count(DISTINCT {name}) AS "unique",
           (SELECT {name} FROM orders GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1) AS top,
           (SELECT count(*) FROM orders GROUP BY {name} ORDER BY count(*) DESC LIMIT 1) AS freq FROM orders
    """


@bind(
    _describe_all_sql("o_orderstatus")
    + " UNION ALL "
    + _describe_all_sql("o_orderpriority")
    + """ UNION ALL SELECT 'o_totalprice', count(o_totalprice), -1, '', -1 FROM orders"""
)
def a2_describe_all(t: Tables):
    found = describe_all(t.orders, ["o_orderstatus", "o_orderpriority", "o_totalprice"])
    return found.select(
        "column",
        "count",
        F.coalesce("unique", F.lit(-1)).alias("unique"),
        F.coalesce("top", F.lit("")).alias("top"),
        F.coalesce("freq", F.lit(-1)).alias("freq"),
    )


NULLED = """
    (SELECT l_quantity, CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS l_extendedprice,
            CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount, l_tax FROM lineitem)
"""


def _nulled(t: Tables):
    return t.lineitem.select(
        "l_quantity",
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        "l_tax",
    )


def _corr_sql(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM {NULLED}"
        for a, b in pairs
    )


@bind(_corr_sql([(a, b) for a in MEASURES for b in MEASURES]), ["r"])
def a3_correlation(t: Tables):
    return correlation(_nulled(t), MEASURES)


@bind(_corr_sql([(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[:i]]), ["r"])
def a4_correlation_lower(t: Tables):
    return correlation(_nulled(t), MEASURES, triangle="lower")


# 200 columns made of three, each with its own missing cells
WIDE, SHOWN = 200, (0, 1, 6, 77, 199)


def _wide_cell(k: int) -> str:
    return f"CASE WHEN (l_orderkey + {k}) % 11 <> 0 THEN l_quantity * {k % 5} + l_discount * {k} + (l_partkey * {k}) % 97 END"


def _wide_sql() -> str:
    columns = ", ".join(f"{_wide_cell(k)} AS c{k}" for k in SHOWN)
    return " UNION ALL ".join(
        f"SELECT 'c{i}' AS a, 'c{j}' AS b, corr(c{i}, c{j}) AS r, count(CASE WHEN c{i} IS NOT NULL AND c{j} IS NOT NULL THEN 1 END) AS n FROM wide"
        for i in SHOWN
        for j in SHOWN
        if i > j
    ).join([f"WITH wide AS MATERIALIZED (SELECT {columns} FROM lineitem) ", ""])


@bind(_wide_sql(), ["r"])
def a3_correlation_200_columns(t: Tables):
    """All pairs of 200 columns in one scan; some of them are compared."""
    wide = t.lineitem.select(*[F.expr(_wide_cell(k)).cast("double").alias(f"c{k}") for k in range(WIDE)])
    shown = [f"c{k}" for k in SHOWN]
    return correlation(wide, triangle="lower").filter(F.col("a").isin(shown) & F.col("b").isin(shown))


def _rate_sql(name: str, table: str = "lineitem", positive: str = "l_returnflag = 'R'", label: str | None = None) -> str:
    return f"""
    SELECT '{label or name}' AS "column", CAST({name} AS VARCHAR) AS level,
           CAST(sum(CASE WHEN {positive} THEN 1 ELSE 0 END) AS BIGINT) AS positives, count(*) AS n,
           avg(CASE WHEN {positive} THEN 1.0 ELSE 0.0 END) AS ratio FROM {table} GROUP BY {name}
    """


RATE_COLUMNS = ["l_linestatus", "l_linenumber", "l_suppkey"]
RATES_SQL = " UNION ALL ".join(_rate_sql(c) for c in RATE_COLUMNS)


@bind(RATES_SQL, ["ratio"])
def a5_outcome_rate(t: Tables):
    return outcome_rate(t.lineitem, RATE_COLUMNS, RETURNED).filter("kind = 'level'").drop("kind")


@bind(
    """
    SELECT 'level' AS kind, l_linestatus AS level, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positives,
           count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS ratio
    FROM lineitem WHERE l_linenumber <> 1 GROUP BY l_linestatus
    UNION ALL
    SELECT 'overall', '', CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT), count(*),
           avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) FROM lineitem
    """,
    ["ratio"],
)
def a6_overall_rate(t: Tables):
    some = t.lineitem.withColumn("l_linestatus", F.when(F.col("l_linenumber") != 1, F.col("l_linestatus")))
    return outcome_rate(some, ["l_linestatus"], RETURNED).select(
        "kind", F.coalesce("level", F.lit("")).alias("level"), "positives", "n", "ratio"
    )


@bind(
    f"""
    SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY positives / n, level) AS rank FROM ({RATES_SQL})
    """,
    ["ratio"],
)
def a7_rank_levels(t: Tables):
    return rank_levels(outcome_rate(t.lineitem, RATE_COLUMNS, RETURNED)).drop("kind")


NATION_CUSTOMERS = "(SELECT n_name, n_nationkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def _nation_customers(t: Tables):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))


@bind(
    f"""
    SELECT n_name AS level, CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS positives, count(*) AS n,
           avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) AS ratio, CAST(min(n_nationkey) AS DOUBLE) AS position
    FROM {NATION_CUSTOMERS} GROUP BY n_name
    """,
    ["ratio", "position"],
)
def a8_rate_by_companion(t: Tables):
    rates = outcome_rate(_nation_customers(t), ["n_name"], Outcome("c_mktsegment", "BUILDING"), order_by="n_nationkey")
    return rates.filter("kind = 'level'").drop("kind", "column").orderBy("position")


def _fold_sql(rates: str) -> str:
    return f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS place,
                      count(*) OVER (PARTITION BY "column") AS k FROM ({rates}))
    SELECT "column", level, CAST(0 AS BIGINT) AS folded, positives, n, positives / n AS ratio FROM r WHERE k <= 20 OR place <= 14
    UNION ALL
    SELECT "column", 'other ' || CAST(count(*) AS VARCHAR), count(*), CAST(sum(positives) AS BIGINT), CAST(sum(n) AS BIGINT), sum(positives) / sum(n)
    FROM r WHERE k > 20 AND place > 14 GROUP BY "column"
    """


FOLDED = ["p_name", "p_size", "p_type"]


@bind(
    _fold_sql(" UNION ALL ".join(_rate_sql(c, "part", "p_brand = 'Brand#7'") for c in FOLDED)),
    ["ratio"],
)
def a9_fold_rare(t: Tables):
    return fold_rare(outcome_rate(t.part, FOLDED, Outcome("p_brand", "Brand#7")))


@bind(
    """
    WITH o AS (SELECT o_orderstatus AS a, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN '1-URGENT' ELSE o_orderpriority END AS b FROM orders),
         r AS (SELECT a, count(*) AS x FROM o GROUP BY a), c AS (SELECT b, count(*) AS y FROM o GROUP BY b)
    SELECT r.a, c.b, (SELECT count(*) FROM o WHERE o.a = r.a AND o.b = c.b) AS observed, x * y / (SELECT count(*) FROM o) AS expected
    FROM r, c
    """,
    ["expected"],
)
def a10_crosstab(t: Tables):
    raised = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH"), "1-URGENT").otherwise(F.col("o_orderpriority"))
    return crosstab(t.orders.withColumn("o_orderpriority", raised), "o_orderstatus", "o_orderpriority")


@bind(
    """
    WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS a, CAST(o_orderkey AS VARCHAR) AS b FROM orders),
         r AS (SELECT a, count(*) AS x FROM o GROUP BY a), c AS (SELECT b, count(*) AS y FROM o GROUP BY b)
    SELECT a, b, count(*) AS observed, any_value(x) * any_value(y) / (SELECT count(*) FROM o) AS expected
    FROM o JOIN r USING (a) JOIN c USING (b) GROUP BY a, b
    """,
    ["expected"],
)
def a10_crosstab_many_levels(t: Tables):
    return crosstab(t.orders, "o_custkey", "o_orderkey", zero_cells=False)


@bind(
    """
    SELECT o_orderstatus AS "group", o_orderkey - (SELECT min(o_orderkey) FROM orders) AS bin, count(*) AS n, count(*) / (sum(count(*)) OVER (PARTITION BY o_orderstatus)) AS density
    FROM orders GROUP BY o_orderstatus, o_orderkey
    """,
    ["density"],
)
def a13_histogram_of_keys(t: Tables):
    """A discrete histogram of a key lists the bins that occur."""
    return histogram(t.orders, "o_orderkey", "o_orderstatus", scale="discrete").select("group", "bin", "n", "density")


LEVELS = ["p_brand", "p_type", "p_size"]
LEVEL_COUNTS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS level, count(*) AS n FROM part GROUP BY {c}""" for c in LEVELS
)


@bind(LEVEL_COUNTS_SQL)
def a11_level_counts(t: Tables):
    return level_counts(t.part, LEVELS)


@bind(
    f"""
    SELECT "column", level, n, levels FROM (
      SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS place, count(*) OVER (PARTITION BY "column") AS levels
      FROM ({LEVEL_COUNTS_SQL})) WHERE place = 1
    """
)
def a12_reference_levels(t: Tables):
    return reference_levels(t.part, LEVELS)


def _histogram_sql(x: str, table: str, group: str, bins: int, edge: str) -> str:
    return f"""
    WITH v AS (SELECT {group} AS g, {x} AS x FROM {table}),
         e AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM v WHERE x IS NOT NULL),
         b AS (SELECT g, least(CAST(floor((x - lo) / w) AS BIGINT), {bins - 1}) AS bin FROM v, e WHERE x IS NOT NULL),
         gs AS (SELECT g, count(*) AS total FROM b GROUP BY g),
         bs AS (SELECT range AS bin FROM range({bins}))
    SELECT gs.g AS "group", bs.bin AS bin, {edge.format(at="lo + bs.bin * w")} AS lo, {edge.format(at="lo + (bs.bin + 1) * w")} AS hi,
           count(b.bin) AS n, count(b.bin) / (any_value(total) * any_value(w)) AS density
    FROM gs CROSS JOIN bs CROSS JOIN e LEFT JOIN b ON b.g = gs.g AND b.bin = bs.bin GROUP BY gs.g, bs.bin, lo, w
    """


@bind(_histogram_sql("value", "events", "event_type", 36, "{at}"), ["lo", "hi", "density"])
def a13_histogram_linear(t: Tables):
    return histogram(t.events, "value", "event_type")


@bind(
    _histogram_sql("CASE WHEN value > 0 THEN log10(value) END", "events", "event_type", 36, "pow(10.0, {at})"),
    ["lo", "hi", "density"],
)
def a13_histogram_log(t: Tables):
    return histogram(t.events, "value", "event_type", scale="log10")


@bind(
    """
    WITH g AS (SELECT l_returnflag AS g, count(*) AS total FROM lineitem GROUP BY 1)
    SELECT l_returnflag AS "group", CAST(l_quantity - 1 AS BIGINT) AS bin, l_quantity - 0.5 AS lo, l_quantity + 0.5 AS hi, count(*) AS n,
           count(*) / any_value(total) AS density
    FROM lineitem JOIN g ON g.g = l_returnflag GROUP BY l_returnflag, l_quantity
    """,
    ["lo", "hi", "density"],
)
def a13_histogram_discrete(t: Tables):
    return histogram(t.lineitem, "l_quantity", "l_returnflag", scale="discrete", empty_bins=True)


def _shape_sql(x: str, table: str, label: str) -> str:
    return f"""
    SELECT *, CAST(skewed = 0 AND discrete = 0 AND max > 1.5 * high_quantile AS BIGINT) AS clipped FROM (
      SELECT '{label}' AS "column", any_value(zero_share) AS zero_share, CAST(any_value(zero_share) > 0.5 AS BIGINT) AS skewed,
             CAST(count(DISTINCT x) <= 20 AS BIGINT) AS discrete,
             CASE WHEN count(DISTINCT x) <= 20 THEN count(DISTINCT x) ELSE -1 END AS distinct_values,
             max(x) AS max, quantile_cont(x, 0.995) AS high_quantile
      FROM (SELECT {x} AS x FROM {table}),
           (SELECT avg(CASE WHEN {x} = 0 THEN 1.0 ELSE 0.0 END) AS zero_share FROM {table})
      WHERE zero_share <= 0.5 OR x > 0)
    """


RARE_GAIN = "CASE WHEN event_id % 4 = 0 THEN value ELSE 0.0 END"


@bind(
    " UNION ALL ".join(
        [
            _shape_sql("value", "events", "value"),
            _shape_sql(RARE_GAIN, "events", "gain"),
            _shape_sql("CAST(user_id % 19 AS DOUBLE)", "events", "code"),
        ]
    ),
    ["zero_share", "max", "high_quantile"],
)
def a14_shape_profile(t: Tables):
    shaped = t.events.select(
        "value",
        F.when(F.col("event_id") % 4 == 0, F.col("value")).otherwise(0.0).alias("gain"),
        (F.col("user_id") % 19).alias("code"),
    )
    return shape_profile(shaped, ["value", "gain", "code"]).withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(-1))
    )


@bind(
    """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
               FROM events GROUP BY event_type)
    SELECT e.event_type AS "group", count(*) AS n, avg(value) AS mean,
           min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS whisker_low, q1, median, q3,
           max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS whisker_high
    FROM events e JOIN q ON e.event_type = q.event_type GROUP BY e.event_type, q1, median, q3
    """,
    ["mean", "whisker_low", "q1", "median", "q3", "whisker_high"],
)
def a15_box_stats(t: Tables):
    return box_stats(t.events, "value", "event_type")


@bind(
    """
    SELECT 'top' AS "end", row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place, c_custkey, c_acctbal
    FROM (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 8)
    UNION ALL
    SELECT 'bottom', row_number() OVER (ORDER BY c_acctbal, c_custkey), c_custkey, c_acctbal
    FROM (SELECT * FROM customer ORDER BY c_acctbal, c_custkey LIMIT 8)
    """,
    ["c_acctbal"],
)
def a16_top_bottom(t: Tables):
    return top_bottom(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 8, ["c_custkey"])
