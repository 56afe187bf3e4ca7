"""Comparison and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import Tables, bind
from outcome_lens.contract import Outcome
from outcome_lens.operators.caveats import level_purity, topcode_profile
from outcome_lens.operators.compare import compare_frames, compare_multisets, comparison_summary
from outcome_lens.operators.quality import (
    clean,
    cleaning_summary,
    dedup,
    funnel,
    missingness_impact,
    null_profile,
)
from outcome_lens.operators.splits import split_overlap, unseen_levels
from outcome_lens.plans.conclusions import equality_verdict

LABELLED = "(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _labelled(t: Tables):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


def _edited_customers(t: Tables):
    c = t.customer.filter("c_custkey % 13 <> 5")
    extra = t.customer.filter("c_custkey % 17 = 3").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    ).unionByName(extra)


EDITED_CUSTOMERS = """
    (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN upper(c_name) ELSE c_name END AS c_name,
            CASE WHEN c_custkey % 4 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey,
            CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
            CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment
     FROM customer WHERE c_custkey % 13 <> 5
     UNION ALL
     SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 17 = 3)
"""


def _column_diff(name: str, kind: str) -> str:
    return f"""
    SELECT '{name}' AS "column", '{kind}' AS left_type, '{kind}' AS right_type, CAST(0 AS BIGINT) AS type_mismatch,
           count(*) FILTER (WHERE (a.{name} IS NULL) <> (b.{name} IS NULL)) AS null_mismatch,
           count(*) FILTER (WHERE a.{name} <> b.{name}) AS value_mismatch
    FROM customer a JOIN {EDITED_CUSTOMERS} b ON a.c_custkey = b.c_custkey
    """


@bind(
    " UNION ALL ".join(
        _column_diff(n, k)
        for n, k in (("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "float"), ("c_mktsegment", "string"))
    )
)
def q1_compare_frames(t: Tables):
    return compare_frames(t.customer, _edited_customers(t), ["c_custkey"])


@bind(
    f"""
    SELECT CAST(1 AS BIGINT) AS columns_match, CAST(count(a.c_custkey) = count(b.c_custkey) AS BIGINT) AS rows_match,
           count(a.c_custkey) AS left_rows, count(b.c_custkey) AS right_rows,
           count(*) FILTER (WHERE b.c_custkey IS NULL) AS missing_keys,
           count(*) FILTER (WHERE a.c_custkey IS NULL) AS extra_keys,
           CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS type_mismatch,
           CAST(0 AS BIGINT) AS identical, 'not comparable' AS verdict
    FROM customer a FULL JOIN {EDITED_CUSTOMERS} b ON a.c_custkey = b.c_custkey
    """
)
def q1_comparison_summary(t: Tables):
    summary = comparison_summary(t.customer, _edited_customers(t), ["c_custkey"])
    return equality_verdict(summary).drop("null_mismatch", "value_mismatch")


@bind(
    """
    SELECT CAST(1 AS BIGINT) AS columns_match, CAST(1 AS BIGINT) AS rows_match, count(*) AS left_rows, count(*) AS right_rows,
           CAST(0 AS BIGINT) AS missing_keys, CAST(0 AS BIGINT) AS extra_keys, CAST(0 AS BIGINT) AS duplicate_keys,
           CAST(0 AS BIGINT) AS type_mismatch,
           count(*) FILTER (WHERE o_orderkey % 6 = 0) AS null_mismatch,
           count(*) FILTER (WHERE o_orderkey % 6 <> 0 AND o_orderkey % 10 = 1) AS value_mismatch,
           CAST(0 AS BIGINT) AS identical
    FROM orders
    """
)
def q1_comparison_cells(t: Tables):
    changed = t.orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderkey") % 6 == 0, F.lit(float("nan")))
        .when(F.col("o_orderkey") % 10 == 1, F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")),
    )
    return comparison_summary(t.orders, changed, ["o_orderkey"])


PART_ROWS = "SELECT p_name, p_brand, CASE WHEN p_size % 7 <> 0 THEN p_type END AS p_type FROM part"
PART_EDITED = """
    SELECT p_name, p_brand, CASE WHEN p_size % 7 <> 0 AND p_partkey % 50 <> 1 THEN p_type END AS p_type
    FROM part WHERE p_partkey % 40 <> 2
"""


@bind(
    f"""
    SELECT p_name, p_brand, coalesce(p_type, '(null)') AS p_type, count(*) FILTER (WHERE side = 1) AS left_copies,
           count(*) FILTER (WHERE side = 2) AS right_copies
    FROM (SELECT *, 1 AS side FROM ({PART_ROWS}) UNION ALL SELECT *, 2 AS side FROM ({PART_EDITED}))
    GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE side = 1) <> count(*) FILTER (WHERE side = 2)
    """
)
def q2_compare_multisets(t: Tables):
    kept = F.when(F.col("p_size") % 7 != 0, F.col("p_type"))
    left = t.part.select("p_name", "p_brand", kept.alias("p_type"))
    right = t.part.filter("p_partkey % 40 <> 2").select(
        "p_name", "p_brand", F.when(F.col("p_partkey") % 50 != 1, kept).alias("p_type")
    )
    return compare_multisets(left, right).withColumn("p_type", F.coalesce("p_type", F.lit("(null)")))


@bind(
    f"""
    SELECT "column", nulls, "rows" FROM (
      SELECT 'quality' AS "column", count(*) - count(quality) AS nulls, count(*) AS "rows" FROM {LABELLED}
      UNION ALL SELECT 'toxic', count(*) - count(toxic), count(*) FROM {LABELLED}
      UNION ALL SELECT 'lang', count(*) - count(lang), count(*) FROM {LABELLED}
      UNION ALL SELECT 'source', count(*) - count(source), count(*) FROM {LABELLED}
      UNION ALL SELECT 'doc_id', count(*) - count(doc_id), count(*) FROM {LABELLED}
      UNION ALL SELECT 'n_chars', count(*) - count(n_chars), count(*) FROM {LABELLED}) WHERE nulls > 0
    """
)
def q3_null_profile(t: Tables):
    return null_profile(_labelled(t))


@bind(
    f"""
    SELECT 'group' AS kind, lang AS "group", count(*) AS total, count(*) - count(quality) AS removed,
           (count(*) - count(quality)) / count(*) AS drop_rate, -1.0 AS rate_before, -1.0 AS rate_after
    FROM {LABELLED} GROUP BY lang
    UNION ALL
    SELECT 'overall', '', count(*), count(*) - count(quality), (count(*) - count(quality)) / count(*),
           avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END),
           avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) FILTER (WHERE quality IS NOT NULL)
    FROM {LABELLED}
    """,
    ["drop_rate", "rate_before", "rate_after"],
)
def q4_missingness_impact(t: Tables):
    return missingness_impact(_labelled(t), Outcome("lang", "en")).select(
        "kind",
        F.coalesce("group", F.lit("")).alias("group"),
        "total",
        "removed",
        "drop_rate",
        F.coalesce("rate_before", F.lit(-1.0)).alias("rate_before"),
        F.coalesce("rate_after", F.lit(-1.0)).alias("rate_after"),
    )


@bind(
    f"SELECT DISTINCT lang, source, n_chars, quality, toxic FROM {LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL"
)
def q5_clean_drop(t: Tables):
    return clean(_labelled(t).drop("doc_id"))


@bind(
    f"""
    SELECT 'drop' AS strategy, (SELECT count(*) FROM {LABELLED}) AS raw,
           (SELECT count(*) FROM {LABELLED} WHERE quality IS NOT NULL) AS complete,
           (SELECT count(*) FROM (SELECT DISTINCT lang, source, quality, toxic FROM {LABELLED} WHERE quality IS NOT NULL)) AS clean
    """
)
def q5_funnel_drop(t: Tables):
    return funnel(_labelled(t).drop("doc_id", "n_chars"))


GRADED = f"""
    (SELECT lang, CASE WHEN n_chars % 10 <> 0 THEN source END AS source, CASE WHEN n_chars % 7 <> 0 THEN n_chars END AS n_chars,
            CAST(quality AS VARCHAR) AS grade FROM {LABELLED})
"""


def _graded(t: Tables):
    return _labelled(t).select(
        "lang",
        F.when(F.col("n_chars") % 10 != 0, F.col("source")).alias("source"),
        F.when(F.col("n_chars") % 7 != 0, F.col("n_chars")).alias("n_chars"),
        F.col("quality").cast("string").alias("grade"),
    )


@bind(
    f"""
    SELECT DISTINCT lang, coalesce(source, 'Unknown') AS source, n_chars, coalesce(grade, 'Unknown') AS grade
    FROM {GRADED} WHERE n_chars IS NOT NULL
    """
)
def q6_clean_unknown(t: Tables):
    return clean(_graded(t), "unknown", ["lang", "source", "grade"])


@bind(
    f"""
    SELECT 'unknown' AS strategy, count(*) AS raw, count(n_chars) AS complete,
           (SELECT count(*) FROM (SELECT DISTINCT lang, coalesce(source, 'Unknown'), n_chars, coalesce(grade, 'Unknown')
                                  FROM {GRADED} WHERE n_chars IS NOT NULL)) AS clean
    FROM {GRADED}
    """
)
def q6_funnel_unknown(t: Tables):
    return funnel(_graded(t), "unknown", ["lang", "source", "grade"])


@bind("SELECT DISTINCT text, lang, source, n_chars FROM documents")
def q7_dedup(t: Tables):
    return dedup(t.documents.drop("doc_id"))


SIZED_PARTS = "(SELECT p_partkey, p_brand, p_type, CASE WHEN p_size % 9 <> 0 THEN p_size END AS p_size FROM part)"


def _sized_parts(t: Tables):
    sized = F.when(F.col("p_size") % 9 != 0, F.col("p_size")).alias("p_size")
    p = t.part.select("p_partkey", "p_brand", "p_type", sized)
    return p.filter("p_partkey % 3 <> 0").drop("p_partkey"), p.filter("p_partkey % 3 = 0").drop("p_partkey")


@bind(
    f"""
    WITH train AS (SELECT * FROM {SIZED_PARTS} WHERE p_partkey % 3 <> 0),
         test AS (SELECT * FROM {SIZED_PARTS} WHERE p_partkey % 3 = 0),
         pairs AS (SELECT b.p_partkey AS test_key, a.p_brand, a.p_type, a.p_size FROM train a JOIN test b
                   ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size IS NOT DISTINCT FROM b.p_size)
    SELECT count(*) AS pair_rows, (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type, p_size FROM pairs)) AS distinct_rows,
           count(DISTINCT test_key) AS test_rows_hit
    FROM pairs
    """
)
def q8_split_overlap(t: Tables):
    train, test = _sized_parts(t)
    return split_overlap(train, test)


@bind(
    """
    WITH m AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_orderdate >= TIMESTAMP '1997-06-01' AND o_custkey % 7 = 3 THEN 'new' ELSE o_orderstatus || CAST(o_custkey % 7 AS VARCHAR) END AS code FROM orders),
         train AS (SELECT * FROM m WHERE o_orderdate < TIMESTAMP '1997-01-01' ),
         test AS (SELECT * FROM m WHERE o_orderdate >= TIMESTAMP '1996-12-01'),
         flags AS (SELECT month NOT IN (SELECT month FROM train) AS new_month, code NOT IN (SELECT code FROM train) AS new_code FROM test)
    SELECT 'month' AS "column", count(*) AS test_rows, count(*) FILTER (WHERE new_month) AS unseen_rows FROM flags
    UNION ALL SELECT 'code', count(*), count(*) FILTER (WHERE new_code) FROM flags
    UNION ALL SELECT '(any)', count(*), count(*) FILTER (WHERE new_month OR new_code) FROM flags
    """
)
def q9_unseen_levels(t: Tables):
    m = t.orders.select(
        "o_orderdate",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(F.expr("o_orderdate >= timestamp '1997-06-01' and o_custkey % 7 = 3"), "new")
        .otherwise(F.concat("o_orderstatus", (F.col("o_custkey") % 7).cast("string")))
        .alias("code"),
    )
    train = m.filter("o_orderdate < timestamp '1997-01-01'")
    test = m.filter("o_orderdate >= timestamp '1996-12-01'")
    return unseen_levels(train, test, ["month", "code"]).withColumn("column", F.coalesce("column", F.lit("(any)")))


def _topcode_sql(name: str, cap: int) -> str:
    return f"""
    SELECT '{name}' AS "column", CAST({cap} AS DOUBLE) AS cap, count(*) AS "rows", count(*) FILTER (WHERE {name} = {cap}) AS capped_rows,
           coalesce(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) FILTER (WHERE {name} = {cap}), 0) AS capped_positive_rate,
           avg(CASE WHEN {name} = 0 THEN 1.0 ELSE 0.0 END) AS zero_share
    FROM lineitem
    """


@bind(
    _topcode_sql("l_quantity", 50) + " UNION ALL " + _topcode_sql("l_discount", 7),
    ["cap", "capped_positive_rate", "zero_share"],
)
def q10_topcode_profile(t: Tables):
    outcome = Outcome("l_returnflag", "R")
    return topcode_profile(t.lineitem, "l_quantity", 50, outcome).unionByName(
        topcode_profile(t.lineitem, "l_discount", 7, outcome)
    )


@bind(
    """
    WITH c AS (SELECT o_orderpriority AS level, o_orderstatus AS s, count(*) AS k FROM orders GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY k DESC, s) AS place, sum(k) OVER (PARTITION BY level) AS n FROM c)
    SELECT level, s AS dominant, k / n AS share, CAST(n AS BIGINT) AS n FROM r WHERE place = 1
    """,
    ["share"],
)
def q11_level_purity(t: Tables):
    return level_purity(t.orders, of="o_orderstatus", given="o_orderpriority")


@bind(
    """
    SELECT 'n' || CAST(c.c_nationkey AS VARCHAR) AS level, CAST(min(n.n_regionkey) AS VARCHAR) AS dominant, 1.0 AS share, count(*) AS n
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_nationkey IN (3, 5, 7) GROUP BY c.c_nationkey
    """,
    ["share"],
)
def q11_level_purity_of_chosen_levels(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "nation", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    )
    return level_purity(joined, of="n_regionkey", given="nation", levels=["n3", "n5", "n7", "n99"])


def _summary_sql(split: str, condition: str) -> str:
    rows = f"(SELECT * FROM {LABELLED} WHERE {condition})"
    groups = f"(SELECT lang, count(*) AS total, count(*) - count(quality) AS removed FROM {rows} GROUP BY lang)"
    return f"""
    SELECT '{split}' AS split, 'rows' AS measure, 'raw' AS item, CAST(count(*) AS DOUBLE) AS value FROM {rows}
    UNION ALL SELECT '{split}', 'rows', 'complete', count(quality) FROM {rows}
    UNION ALL SELECT '{split}', 'rows', 'clean', count(*) FROM (SELECT DISTINCT lang, source, quality, toxic FROM {rows} WHERE quality IS NOT NULL)
    UNION ALL SELECT '{split}', 'nulls', 'quality', count(*) - count(quality) FROM {rows}
    UNION ALL SELECT '{split}', 'nulls', 'toxic', count(*) - count(toxic) FROM {rows}
    UNION ALL SELECT '{split}', 'total', lang, total FROM {groups}
    UNION ALL SELECT '{split}', 'removed', lang, removed FROM {groups}
    UNION ALL SELECT '{split}', 'drop_rate', lang, removed / total FROM {groups}
    UNION ALL SELECT '{split}', 'total', '', count(*) FROM {rows}
    UNION ALL SELECT '{split}', 'removed', '', count(*) - count(quality) FROM {rows}
    UNION ALL SELECT '{split}', 'drop_rate', '', (count(*) - count(quality)) / count(*) FROM {rows}
    UNION ALL SELECT '{split}', 'rate_before', '', avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) FROM {rows}
    UNION ALL SELECT '{split}', 'rate_after', '', avg(CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END) FROM {rows} WHERE quality IS NOT NULL
    """


@bind(_summary_sql("train", "doc_id % 3 <> 0") + " UNION ALL " + _summary_sql("test", "doc_id % 3 = 0"), ["value"])
def q12_cleaning_summary(t: Tables):
    rows = _labelled(t)
    splits = {
        "train": rows.filter("doc_id % 3 <> 0").drop("doc_id", "n_chars"),
        "test": rows.filter("doc_id % 3 = 0").drop("doc_id", "n_chars"),
    }
    return cleaning_summary(splits, Outcome("lang", "en"))
