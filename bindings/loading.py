"""Sources and sinks over files that Spark writes from the test tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bindings.registry import Tables, bind
from outcome_lens.contract import AnalysisError, Field, Outcome, SourceContract
from outcome_lens.operators.rates import outcome_rate
from outcome_lens.session import new_path
from outcome_lens.sources import normalise, parsing, published_runs, read_contract, read_quarantined, read_raw, read_results, write_results

ORDER_LINES = SourceContract(
    fields=(
        Field("order_key", "int"),
        Field("customer_key", "int"),
        Field("priority", "string"),
        Field("total", "float"),
        Field("status", "string"),
    ),
    outcome=Outcome("status", "F"),
)

ORDER_ROWS_SQL = """
    SELECT o_orderkey AS order_key,
           CASE WHEN o_custkey % 10 = 0 THEN -1 ELSE o_custkey END AS customer_key,
           CASE WHEN o_orderpriority = '5-LOW' THEN '(none)' ELSE o_orderpriority END AS priority,
           o_totalprice AS total,
           o_orderstatus AS status
    FROM orders
"""


def _order_file(t: Tables) -> str:
    """The orders as a headerless file: padded cells, ? for some, dotted labels, comments, blanks."""
    priority = F.when(F.col("o_orderpriority") == "5-LOW", "?").otherwise(F.col("o_orderpriority"))
    customer = F.when(F.col("o_custkey") % 10 == 0, F.lit("?")).otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(
        ", ", F.col("o_orderkey").cast("string"), customer, priority, F.col("o_totalprice").cast("string"),
        F.concat(F.col("o_orderstatus"), F.lit(".")),
    )
    marked = F.when(F.col("o_orderkey") % 100 == 0, F.array(F.lit("|a comment, with, commas"), F.lit(""), line))
    made = (t.spark.sparkContext.applicationId, t.folder)
    if made not in _order_files:  # several queries of a session read the same file
        path = new_path(t.spark, "orders-csv")
        t.orders.select(F.explode(F.coalesce(marked, F.array(line))).alias("value")).write.text(path)
        _order_files[made] = path
    return _order_files[made]


_order_files: dict[tuple[str, str], str] = {}


def prepare(spark: SparkSession, folder: str) -> None:
    """Write the file that the source queries read, so that a timing of these is one of reading."""
    _order_file(Tables(spark, folder))


def _shown(df):
    return df.select(
        "order_key",
        F.coalesce("customer_key", F.lit(-1)).alias("customer_key"),
        F.coalesce("priority", F.lit("(none)")).alias("priority"),
        "total",
        "status",
    )


@bind(
    """
    SELECT 'good' AS file, count(*) AS "rows", '' AS failed FROM orders
    UNION ALL SELECT 'malformed', 0, 'cannot parse' FROM region WHERE r_regionkey = 0
    UNION ALL SELECT 'absent', 0, 'no data file' FROM region WHERE r_regionkey = 0
    """
)
def s3_domain_error(t: Tables):
    """One row a file: its rows, or the domain error that reading it ends in."""
    bad = new_path(t.spark, "malformed-csv")
    t.orders.select(F.concat_ws(", ", "o_orderstatus", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus").alias("value")).write.text(bad)
    rows = []
    for file, path in (("good", _order_file(t)), ("malformed", bad), ("absent", new_path(t.spark, "absent-csv"))):
        try:
            with parsing(path):
                found = read_contract(t.spark, path, ORDER_LINES).agg(*[F.count(F.lit(1)).alias("n"), F.count("order_key"), F.count("total")]).first()
            rows.append((file, found["n"], ""))
        except AnalysisError as error:
            rows.append((file, 0, next((k for k in ("cannot parse", "no data file") if k in str(error)), str(error))))
    return t.spark.createDataFrame(rows, "file string, rows long, failed string")


@bind(ORDER_ROWS_SQL, ["total"])
def s1_read_contract(t: Tables):
    return _shown(read_contract(t.spark, _order_file(t), ORDER_LINES))


@bind(ORDER_ROWS_SQL, ["total"])
def s2_read_raw_normalise(t: Tables):
    return _shown(normalise(read_raw(t.spark, _order_file(t), ORDER_LINES), ORDER_LINES))


PART_LINES = SourceContract(
    fields=(Field("key", "int"), Field("size", "int"), Field("brand", "string"), Field("kind", "string")),
    outcome=Outcome("kind", "PROMO"),
)


def _part_texts(t: Tables):
    size = F.when(F.col("p_size") == 13, F.lit("thirteen")).when(F.col("p_size") == 14, F.lit(" ? "))
    return t.part.select(
        F.concat(F.lit("  "), F.col("p_partkey").cast("string")).alias("key"),
        F.coalesce(size, F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_partkey") % 9 == 0, F.lit(" ?")).otherwise(F.concat(F.lit(" "), "p_brand", F.lit("  "))).alias("brand"),
        F.concat("p_type", F.lit("..")).alias("kind"),
    )


@bind(
    """
    SELECT p_partkey AS key, CASE WHEN p_size = 14 THEN -1 ELSE p_size END AS size,
           CASE WHEN p_partkey % 9 = 0 THEN '(none)' ELSE p_brand END AS brand, p_type AS kind
    FROM part WHERE p_size <> 13
    """
)
def s2_normalise(t: Tables):
    typed, _ = normalise(_part_texts(t), PART_LINES, on_error="quarantine")
    return typed.select("key", F.coalesce("size", F.lit(-1)).alias("size"), F.coalesce("brand", F.lit("(none)")).alias("brand"), "kind")


@bind(
    """
    SELECT '  ' || CAST(p_partkey AS VARCHAR) AS key, 'thirteen' AS size, 'size' AS failed
    FROM part WHERE p_size = 13
    """
)
def s2_normalise_rejected(t: Tables):
    _, rejected = normalise(_part_texts(t), PART_LINES, on_error="quarantine")
    return rejected.select("key", "size", F.concat_ws(",", "failed_columns").alias("failed"))


@bind(
    """
    SELECT 'first' AS run_id, l_linestatus AS level, count(*) AS n,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positives
    FROM lineitem GROUP BY l_linestatus
    """
)
def s5_write_results(t: Tables):
    path = new_path(t.spark, "results")
    rates = outcome_rate(t.lineitem, ["l_linestatus"], Outcome("l_returnflag", "R"))
    write_results({"rates": rates}, path, "first")
    write_results({"rates": rates.withColumn("n", F.lit(0).cast("long"))}, path, "second")
    return read_results(t.spark, path, "rates", "first").filter("kind = 'level'").select("run_id", "level", "n", "positives")


# lines with three cells, with seven, and with a cell that is no number
SHORT, LONG, BAD = "o_orderkey % 50 = 1", "o_orderkey % 50 = 2", "o_orderkey % 50 = 3"


@bind(
    f"""
    SELECT 'typed' AS kind, o_orderkey AS order_key, o_orderstatus AS shown FROM orders WHERE NOT ({SHORT} OR {LONG} OR {BAD})
    UNION ALL SELECT 'line', o_orderkey, CAST(o_orderkey AS VARCHAR) || ', ' || CAST(o_custkey AS VARCHAR) || ', ' || o_orderpriority FROM orders WHERE {SHORT}
    UNION ALL SELECT 'line', o_orderkey, CAST(o_orderkey AS VARCHAR) || ', ' || CAST(o_custkey AS VARCHAR) || ', ' || o_orderpriority || ', 1, F., more, cells'
      FROM orders WHERE {LONG}
    UNION ALL SELECT 'cells', o_orderkey, 'total' FROM orders WHERE {BAD}
    """
)
def s2_quarantine_lines(t: Tables):
    """Short lines, long lines and bad cells lie apart from the good rows of one file, and none fails the job."""
    short, long, bad = (F.expr(e) for e in (SHORT, LONG, BAD))
    start = F.concat_ws(", ", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderpriority")
    rest = F.when(short, F.lit("")).when(long, F.lit(", 1, F., more, cells")).when(bad, F.lit(", much, F.")).otherwise(F.concat(F.lit(", 10.5, "), "o_orderstatus", F.lit(".")))
    path = new_path(t.spark, "broken-csv")
    t.orders.select(F.concat(start, rest).alias("value")).write.text(path)
    typed, rejected = read_quarantined(t.spark, path, ORDER_LINES)
    shown = F.when(F.col("reason") == "line", F.col("line")).otherwise(F.array_join("failed_columns", ","))
    return typed.select(F.lit("typed").alias("kind"), "order_key", F.col("status").alias("shown")).unionByName(
        rejected.filter("file is not null and block is not null").select(F.col("reason").alias("kind"), F.trim("order_key").cast("int").alias("order_key"), shown.alias("shown"))
    )


@bind(
    """
    SELECT 'first' AS run_id, l_linestatus AS level, count(*) AS n, 1 AS published FROM lineitem GROUP BY l_linestatus
    """
)
def s5_killed_write(t: Tables):
    """A write of the same run that ends after its first table leaves the run as it was."""
    path = new_path(t.spark, "results")
    rates = outcome_rate(t.lineitem, ["l_linestatus"], Outcome("l_returnflag", "R"))
    write_results({"rates": rates}, path, "first")
    broken = rates.withColumn("n", F.raise_error(F.lit("killed")).cast("long"))
    try:
        write_results({"rates": rates.withColumn("n", F.lit(0).cast("long")), "more": broken}, path, "first")
    except AnalysisError:
        published = published_runs(t.spark, path).count()
    return read_results(t.spark, path, "rates", "first").filter("kind = 'level'").select("run_id", "level", "n", F.lit(published).alias("published"))
