"""Running totals over a global order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcome_lens.contract import col
from outcome_lens.functions.columns import same_keys
from outcome_lens.session import durable


def running_totals(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Add each total, summed from the first row of its group up to and including the row.

    ``(by, order)`` must be unique, as it is after a ``groupBy``; pre-aggregation is what keeps a
    hot value from filling one slice. Rows are range-partitioned into slices, as many as adaptive execution finds
    the data need: totals run within a slice, and the sum of the slices before it is
    added. The slice number is written out before use, so a retried task cannot move a row.
    """
    group = [col(b) for b in by]
    named = df.select("*", *[c.alias(f"_add_{t}") for t, c in totals.items()])
    sliced = durable(named.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()))
    earlier = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    before = (
        sliced.groupBy(*group, "_slice")
        .agg(*[F.sum(f"_add_{t}").alias(f"_sum_{t}") for t in totals])
        .select(
            *group,
            "_slice",
            *[F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_before_{t}") for t in totals],
        )
    )
    inside = W.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = sliced.select("*", *[F.sum(f"_add_{t}").over(inside).alias(f"_local_{t}") for t in totals])
    joined = same_keys(local, before, [*by, "_slice"])
    return joined.select(
        *[col(c) for c in df.columns],
        *[(F.col(f"_before_{t}") + F.col(f"_local_{t}")).alias(t) for t in totals],
    )
