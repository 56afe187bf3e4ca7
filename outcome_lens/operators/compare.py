"""Whether two tables are equal, cell by cell over keys or as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col
from outcome_lens.functions.columns import missing, require, semantic_type
from outcome_lens.session import durable

BUCKETS = 1 << 16


def _types(left: DataFrame, right: DataFrame, names: Sequence[str]) -> dict[str, tuple[str, str]]:
    return {
        n: (semantic_type(left.schema[n].dataType), semantic_type(right.schema[n].dataType)) for n in names
    }


def _both_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key with the cells of both sides.

    Grouping the union, not joining the sides, keeps a key that is repeated on both sides from
    multiplying; such keys are counted and carry no comparable cells.
    """
    def side(df: DataFrame, mine: str, other: DataFrame, theirs: str) -> DataFrame:
        blank = [
            F.lit(None).cast(other.schema[n].dataType).alias(f"_{theirs}{i}") for i, n in enumerate(names)
        ]
        own = [F.when(~missing(df, n), col(n)).alias(f"_{mine}{i}") for i, n in enumerate(names)]
        cells = own + blank if mine == "l" else blank + own
        return df.select(
            *[col(k) for k in keys],
            F.lit(int(mine == "l")).alias("_in_left"),
            F.lit(int(mine == "r")).alias("_in_right"),
            *cells,
        )

    union = side(left, "l", right, "r").unionByName(side(right, "r", left, "l"))
    return union.groupBy(*[col(k) for k in keys]).agg(
        F.sum("_in_left").alias("_in_left"),
        F.sum("_in_right").alias("_in_right"),
        *[F.max(f"_{s}{i}").alias(f"_{s}{i}") for s in "lr" for i in range(len(names))],
    )


def _differs(i: int, types: tuple[str, str]) -> Column:
    left, right = F.col(f"_l{i}"), F.col(f"_r{i}")
    if types[0] == types[1] == "string":
        return left.cast("string") != right.cast("string")
    if "string" in types:
        return F.lit(True)  # a number never equals a text
    return left != right


def alike(df: DataFrame, other: DataFrame, name: str) -> Column:
    """The cell in a form that hashes alike on both sides wherever the two sides compare as equal; null if missing."""
    kinds = {semantic_type(d.schema[name].dataType) for d in (df, other)}
    as_type = "string" if "string" in kinds else "double" if "float" in kinds else "long"
    return F.when(~missing(df, name), col(name)).cast(as_type)


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The buckets of keys, ``BUCKETS`` at most, in which the two tables do not hold the same rows.

    Rows are summed up as hashes per bucket, the left ones positive and the right ones negative: a task sends one row a
    bucket. Different rows of a bucket have equal sums with a chance of one in 2^64.
    """

    def side(df: DataFrame, other: DataFrame, sign: int) -> DataFrame:
        cells = [alike(df, other, n) for n in [*keys, *names]]
        # a null leaves a hash as it is: which cells are null is hashed, too
        row = F.xxhash64(*cells, *[c.isNull() for c in cells])
        number = lambda part: (F.lit(sign) * part).cast("long")
        return df.select(
            _bucket(df, other, keys),
            F.lit(sign).alias("_rows"),
            number(row.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"),
            number(F.shiftrightunsigned(row, 32)).alias("_high"),
        )

    sums = side(left, right, 1).unionAll(side(right, left, -1)).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in ("_rows", "_low", "_high")])
    return sums.filter("_rows <> 0 or _low <> 0 or _high <> 0").select("_bucket")


def _bucket(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[alike(df, other, k) for k in keys]), F.lit(BUCKETS)).alias("_bucket")


def _counts(left: DataFrame, right: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    types = _types(left, right, names)
    paired = (F.col("_in_left") == 1) & (F.col("_in_right") == 1)

    def number(condition: Column) -> Column:
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0))

    aggregates = [
        F.coalesce(F.sum("_in_left"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_in_right"), F.lit(0)).alias("right_rows"),
        number(F.col("_in_right") == 0).alias("missing_keys"),
        number(F.col("_in_left") == 0).alias("extra_keys"),
        number((F.col("_in_left") > 1) | (F.col("_in_right") > 1)).alias("duplicate_keys"),
    ]
    for i, n in enumerate(names):
        left_null, right_null = F.col(f"_l{i}").isNull(), F.col(f"_r{i}").isNull()
        aggregates.append(number(paired & (left_null != right_null)).alias(f"_null{i}"))
        aggregates.append(
            number(paired & ~left_null & ~right_null & _differs(i, types[n])).alias(f"_value{i}")
        )
    return _both_sides(left, right, keys, names).agg(*aggregates)


def compare_frames(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per common column: semantic types, and cells whose null state or value differs.

    Cells are paired by key, since a distributed table has no row order; NaN counts as missing. Only rows of
    ``differing_buckets`` are shuffled.
    """
    require(left, *keys)
    require(right, *keys)
    names = [n for n in left.columns if n in right.columns and n not in keys]
    if not names:
        raise AnalysisError("the two tables share no column besides the keys")
    types = _types(left, right, names)
    # cells can only differ in buckets that differ; a text next to a number differs everywhere
    pairs = _types(left, right, [*keys, *names]).values()
    if all("string" not in p or p == ("string", "string") for p in pairs):
        some = F.broadcast(durable(differing_buckets(left, right, keys, names)))  # BUCKETS rows at most
        left, right = (
            a.withColumn("_bucket", _bucket(a, b, keys)).join(some, "_bucket", "left_semi").drop("_bucket") for a, b in ((left, right), (right, left))
        )
    entries = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(types[n][0]).alias("left_type"),
            F.lit(types[n][1]).alias("right_type"),
            F.lit(types[n][0] != types[n][1]).alias("type_mismatch"),
            F.col(f"_null{i}").alias("null_mismatch"),
            F.col(f"_value{i}").alias("value_mismatch"),
        )
        for i, n in enumerate(names)
    ]
    return _counts(left, right, keys, names).select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def comparison_summary(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: whether the tables are identical, and how many cells, keys and types differ.

    Where the column lists or the row counts differ, the cell counts are undefined (NULL).
    """
    require(left, *keys)
    require(right, *keys)
    columns_match = left.columns == right.columns
    names = [n for n in left.columns if n in right.columns and n not in keys]
    types = _types(left, right, [n for n in left.columns if n in right.columns])
    type_mismatch = sum(a != b for a, b in types.values()) if columns_match else 0
    counts = _counts(left, right, keys, names)
    total = {
        kind: sum((F.col(f"_{kind}{i}") for i in range(len(names))), F.lit(0)) for kind in ("null", "value")
    }
    comparable = F.lit(columns_match) & (F.col("left_rows") == F.col("right_rows"))
    return counts.select(
        F.lit(columns_match).alias("columns_match"),
        (F.col("left_rows") == F.col("right_rows")).alias("rows_match"),
        "left_rows",
        "right_rows",
        "missing_keys",
        "extra_keys",
        "duplicate_keys",
        F.lit(type_mismatch).cast("long").alias("type_mismatch"),
        F.when(comparable, total["null"]).alias("null_mismatch"),
        F.when(comparable, total["value"]).alias("value_mismatch"),
        (
            comparable
            & F.lit(type_mismatch == 0)
            & (F.col("missing_keys") + F.col("extra_keys") + F.col("duplicate_keys") == 0)
            & (total["null"] + total["value"] == 0)
        ).alias("identical"),
    )


def compare_multisets(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows whose number of copies differs, with both numbers; empty when the tables are equal.

    For tables without a key. Both sides are counted in one grouping, in which NULL equals NULL.
    """
    if left.columns != right.columns:
        raise AnalysisError("the two tables do not have the same columns in the same order")
    counted = left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(
        right.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    )
    return (
        counted.groupBy(*[col(n) for n in left.columns])
        .agg(F.sum("_l").alias("left_copies"), F.sum("_r").alias("right_copies"))
        .filter(F.col("left_copies") != F.col("right_copies"))
    )


__all__ = ["compare_frames", "compare_multisets", "comparison_summary"]
