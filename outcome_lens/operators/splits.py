"""What a training table and a test table share, and what only the test table has."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.bloom import filter_bits, hash_filter, may_have
from outcome_lens.functions.columns import require, same_keys, to_rows
from outcome_lens.operators.compare import alike
from outcome_lens.session import durable


def _side_counts(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    tagged = train.select(*[col(k) for k in keys], F.lit(1).alias("_train"), F.lit(0).alias("_test")).unionByName(
        test.select(*[col(k) for k in keys], F.lit(0).alias("_train"), F.lit(1).alias("_test"))
    )
    return tagged.groupBy(*[col(k) for k in keys]).agg(
        F.sum("_train").alias("train_rows"), F.sum("_test").alias("test_rows")
    )


def _only_shared(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both splits, the larger one without most of the rows that the smaller one does not have."""
    in_train, in_test = train.count(), test.count()
    small, large = (test, train) if in_test <= in_train else (train, test)

    def hashed(df: DataFrame, other: DataFrame):
        return F.xxhash64(*[alike(df, other, k) for k in keys])

    words = hash_filter(small.select(hashed(small, large)), filter_bits(min(in_train, in_test)))
    large = may_have(large, hashed(large, small), words)
    return (large, small) if in_test <= in_train else (small, large)


def split_overlap(train: DataFrame, test: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows the inner join on the shared columns would have, and from how many.

    Copies are counted per side and multiplied, so no pair of rows is ever formed; the product is a
    decimal, since a row repeated often on both sides passes the range of a long. Of the larger split only rows that a
    Bloom filter of the smaller one may have are shuffled.
    """
    shared = [n for n in train.columns if n in test.columns] if names is None else list(names)
    if not shared:
        raise AnalysisError("the two splits share no column")
    require(train, *shared)
    require(test, *shared)
    train, test = _only_shared(train, test, shared)
    both = (F.col("train_rows") > 0) & (F.col("test_rows") > 0)
    pairs = F.col("train_rows").cast("decimal(19,0)") * F.col("test_rows").cast("decimal(19,0)")
    return _side_counts(train, test, shared).agg(
        F.coalesce(F.sum(F.when(both, pairs)), F.lit(0)).cast("decimal(38,0)").alias("pair_rows"),
        F.count_if(both).alias("distinct_rows"),
        F.coalesce(F.sum(F.when(both, F.col("test_rows"))), F.lit(0)).alias("test_rows_hit"),
    )


def unseen_levels(train: DataFrame, test: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Test rows that hold a level absent from training: per column, and over all columns.

    The last row has ``column`` NULL and counts a test row once, however many of its levels are new.
    """
    names = [n for n in categorical if n in train.columns and n in test.columns]
    if not names:
        raise AnalysisError("none of the categorical columns is in both splits")
    # written once: both splits are read for it, and two steps read it
    levels = durable(_side_counts(to_rows(train, names), to_rows(test, names), ["column", "level"]))
    new = levels.filter("train_rows = 0")
    per_column = levels.groupBy("column").agg(
        F.sum("test_rows").alias("test_rows"),
        F.coalesce(F.sum(F.when(F.col("train_rows") == 0, F.col("test_rows"))), F.lit(0)).alias("unseen_rows"),
    )
    # equal test rows are counted together first, so each distinct one is looked up once
    combos = (
        test.select(*[col(n).cast("string").alias(f"_{i}") for i, n in enumerate(names)])
        .groupBy(*[f"_{i}" for i in range(len(names))])
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    new = durable(new.select("column", "level"))  # of known size: adaptive execution decides how it joins
    for i, n in enumerate(names):
        absent = new.filter(F.col("column") == n).select(F.col("level").alias(f"_{i}"), F.lit(1).alias(f"_new{i}"))
        combos = same_keys(combos, absent, [f"_{i}"], "left")
    is_new = reduce(lambda a, b: a | b, [F.col(f"_new{i}").isNotNull() for i in range(len(names))])
    overall = combos.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("test_rows"),
        F.coalesce(F.sum(F.when(is_new, F.col("_copies"))), F.lit(0)).alias("unseen_rows"),
    ).select(F.lit(None).cast("string").alias("column"), "test_rows", "unseen_rows")
    return per_column.unionByName(overall)
