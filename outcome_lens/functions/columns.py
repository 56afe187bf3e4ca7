"""Column helpers: missing values, safe ratios, columns turned into rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcome_lens.contract import AnalysisError, col


def require(df: DataFrame, *names: str) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise AnalysisError(f"columns not in the table: {', '.join(absent)}")


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def semantic_type(data_type: T.DataType) -> str:
    """``int``, ``float`` or ``string``: the granularity at which two readers must agree."""
    if isinstance(data_type, T.IntegralType):
        return "int"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "float"
    return "string"


def missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN in a floating column: a table has one notion of a missing cell."""
    if is_floating(df, name):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def any_missing(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    flags = [missing(df, n) for n in (df.columns if names is None else names)]
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def number(df: DataFrame, name: str) -> Column:
    """The column as a double, NaN as NULL, so that no aggregate sees a missing cell."""
    value = col(name).cast("double")
    return F.when(~F.isnan(value), value) if is_floating(df, name) else value


def ratio(top: Column, bottom: Column, otherwise: float | None = None) -> Column:
    """``top / bottom``; ``otherwise`` (or NULL) where ``bottom`` is 0."""
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if otherwise is None else F.coalesce(value, F.lit(float(otherwise)))


def to_rows(
    df: DataFrame,
    names: Sequence[str],
    keep: Sequence[str] = (),
    variable: str = "column",
    value: str = "level",
    as_type: str = "string",
) -> DataFrame:
    """One row per (row, column), so that one aggregate serves any number of columns."""
    require(df, *names)
    kept = [k for k in keep]
    cells = df.select(
        *[col(k) for k in kept],
        *[
            (number(df, n) if as_type == "double" else col(n).cast(as_type)).alias(f"_{i}")
            for i, n in enumerate(names)
        ],
    )
    rows = cells.unpivot(kept, [f"_{i}" for i in range(len(names))], "_cell", value)
    # plain positions inside the unpivot keep names with dots or hyphens out of its resolution
    lookup = F.element_at(F.array(*[F.lit(n) for n in names]), F.substring("_cell", 2, 9).cast("int") + 1)
    return rows.withColumn(variable, lookup).drop("_cell")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; the keys of ``left`` are kept once."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_right_{k}")
    match = reduce(
        lambda a, b: a & b, [col(k).eqNullSafe(col(f"_right_{k}")) for k in keys], F.lit(True)
    )
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])
