"""Exact interpolated quantiles of many columns and groups by distributed selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcome_lens.contract import col
from outcome_lens.functions.columns import number, require, same_keys
from outcome_lens.functions.ordering import running_totals
from outcome_lens.session import durable

ACCURACY = 10_000


def quantiles(
    df: DataFrame,
    names: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Rows ``(*by, column, p, value)``; exact values interpolate linearly between neighbours.

    Cut points from a quantile sketch split each column into ranges, the
    ranges are counted, and only the rows in the few narrow ranges that hold a wanted rank are
    shuffled. The sketch decides how narrow those ranges are, never which value is returned.
    ``exact=False`` returns the sketch's own answer, a rank error of at most 1 in 10,000.
    """
    require(df, *names, *by)
    probs = [float(p) for p in probs]
    cells = df.select(*[col(b) for b in by], *[number(df, n).alias(f"_x{i}") for i, n in enumerate(names)])
    if exact:
        return _select(cells, list(names), probs, list(by))
    wanted = F.array(*[F.lit(p) for p in probs])
    wide = cells.groupBy(*[col(b) for b in by]).agg(
        *[F.percentile_approx(F.col(f"_x{i}"), wanted, ACCURACY).alias(f"_q{i}") for i in range(len(names))]
    )
    entries = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(p).alias("p"),
            F.get(F.col(f"_q{i}"), F.lit(j)).alias("value"),
        )
        for i, n in enumerate(names)
        for j, p in enumerate(probs)
    ]
    return wide.select(*[col(b) for b in by], F.explode(F.array(*entries)).alias("_e")).select(
        *[col(b) for b in by], "_e.column", "_e.p", "_e.value"
    )


def _select(cells: DataFrame, names: list[str], probs: list[float], by: list[str]) -> DataFrame:
    group = [col(b) for b in by]
    step = 2.0 / ACCURACY
    grid = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-step, step)})
    positions = F.array(*[F.lit(g) for g in grid])

    sketch = cells.groupBy(*group).agg(
        *[F.percentile_approx(f"_x{i}", positions, ACCURACY).alias(f"_cut{i}") for i in range(len(names))]
    )
    sketch = durable(sketch)  # made in one scan, and read by the steps below
    if by:
        joined = same_keys(cells, sketch, by)
        cuts = [[F.get(F.col(f"_cut{i}"), F.lit(g)) for g in range(len(grid))] for i in range(len(names))]
    else:
        joined, only = cells, sketch.first()
        cuts = [[F.lit(c) for c in only[f"_cut{i}"] or []] for i in range(len(names))]

    def range_of(i: int) -> Column:
        above = [F.coalesce((F.col(f"_x{i}") > cut).cast("int"), F.lit(0)) for cut in cuts[i]]
        return reduce(lambda a, b: a + b, above, F.lit(0))

    coded = joined.select(
        *group,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"), range_of(i).alias("range"), F.col(f"_x{i}").alias("x")
                    )
                    for i, n in enumerate(names)
                ]
            )
        ).alias("_e"),
    ).select(*group, "_e.column", "_e.range", "_e.x")

    key = [*by, "column"]
    in_order = W.partitionBy(*[col(k) for k in key]).orderBy("range")
    ranges = (
        coded.filter(F.col("x").isNotNull())
        .groupBy(*[col(k) for k in key], "range")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_until", F.sum("_rows").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_n", F.sum("_rows").over(W.partitionBy(*[col(k) for k in key])))
    )
    at = F.col("p") * (F.col("_n") - 1)
    wanted = (
        ranges.withColumn("p", F.explode(positions_of(probs)))
        .withColumn("_at", at)
        .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))))
        .filter((F.col("_rank") < F.col("_until")) & (F.col("_rank") >= F.col("_until") - F.col("_rows")))
        .select(*[col(k) for k in key], "range", "p", "_at", "_rank", (F.col("_until") - F.col("_rows")).alias("_skip"))
    )
    wanted = durable(wanted)

    values = (
        same_keys(
            coded.filter(F.col("x").isNotNull()),
            wanted.select(*[col(k) for k in key], "range").distinct(),
            [*key, "range"],
            "left_semi",
        )
        .groupBy(*[col(k) for k in key], "range", "x")
        .agg(F.count("*").alias("_copies"))
    )
    placed = running_totals(values, [*key, "range"], [F.col("x").asc()], {"_upto": F.col("_copies")})
    hit = same_keys(placed, wanted, [*key, "range"]).filter(
        (F.col("_rank") < F.col("_skip") + F.col("_upto"))
        & (F.col("_rank") >= F.col("_skip") + F.col("_upto") - F.col("_copies"))
    )
    low = F.max(F.when(F.col("_rank") == F.floor("_at"), F.col("x")))
    high = F.max(F.when(F.col("_rank") == F.ceil("_at"), F.col("x")))
    part = F.max(F.col("_at") - F.floor("_at"))
    found = hit.groupBy(*[col(k) for k in key], "p").agg((low + (high - low) * part).alias("value"))
    # a column without a value still gets its rows, as it does in the built-in form
    asked = sketch.select(
        *group,
        F.explode(F.array(*[F.lit(n) for n in names])).alias("column"),
    ).withColumn("p", F.explode(positions_of(probs)))
    return same_keys(asked, found, [*key, "p"], "left").select(*group, "column", "p", "value")


def positions_of(probs: Sequence[float]) -> Column:
    return F.array(*[F.lit(p) for p in probs])


__all__ = ["ACCURACY", "quantiles"]
