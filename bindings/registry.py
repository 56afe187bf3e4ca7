"""Operators bound to the test tables: a query, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def nudge(digits: int) -> float:
    """Moves exact rounding ties, such as 1027/16000 at 6 digits, to the same side in both engines."""
    return 3.1 * 10.0 ** -(digits + 4)


class Binding(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


BINDINGS: dict[str, Binding] = {}


def bind(sql: str | None = None, doubles: Sequence[str] = (), digits: int = DIGITS):
    """Register the function under its own name; doubles are rounded alike on both sides."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(function(Tables(spark, folder)), digits)

        BINDINGS[function.__name__] = Binding(run, None if sql is None else tidy_sql(sql, doubles, digits))
        return function

    return register


class Tables:
    """The Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Whole numbers and flags as long, doubles rounded: types two engines agree on."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegralType, T.BooleanType)) or (
            isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0
        ):
            columns.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, T.FractionalType):
            columns.append((F.round(F.col(f.name).cast("double") + F.lit(nudge(digits)), digits) + F.lit(0.0)).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def tidy_sql(sql: str, doubles: Sequence[str], digits: int = DIGITS) -> str:
    if not doubles:
        return sql
    rounded = ", ".join(
        f"round(CAST({c} AS DOUBLE) + CAST({nudge(digits)!r} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE) AS {c}"
        for c in doubles
    )
    return f"SELECT * REPLACE ({rounded}) FROM ({sql}) AS result"
