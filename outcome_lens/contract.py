"""What a caller has to state about a table: its outcome, and its columns as they lie on disk."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class AnalysisError(Exception):
    """The only error type that leaves the public functions of this package."""


def col(name: str) -> Column:
    """A column by its exact name; names may hold hyphens, dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Outcome:
    """A label column and the value that counts as positive."""

    column: str
    positive: str | int | float | bool

    def flag(self) -> Column:
        """1 for a positive row, 0 for any other row, a missing label included."""
        return F.coalesce((col(self.column) == F.lit(self.positive)).cast("int"), F.lit(0))


@dataclass(frozen=True)
class Field:
    """One column of a source. ``cap`` marks a top-coded value ("this much or more")."""

    name: str
    kind: str  # "int", "float" or "string"
    cap: float | None = None

    def spark_type(self) -> T.DataType:
        kinds = {"int": T.LongType(), "float": T.DoubleType(), "string": T.StringType()}
        if self.kind not in kinds:
            raise AnalysisError(f"field {self.name}: unknown kind {self.kind!r}")
        return kinds[self.kind]


@dataclass(frozen=True)
class SourceContract:
    """How a headerless delimited file is read: fixed columns, null token, comment mark, label."""

    fields: tuple[Field, ...]
    outcome: Outcome
    null_token: str = "?"
    comment: str = "|"
    label_suffix: str = "."
    delimiter: str = ","

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def numeric(self) -> list[str]:
        return [f.name for f in self.fields if f.kind != "string"]

    @property
    def categorical(self) -> list[str]:
        return [f.name for f in self.fields if f.kind == "string" and f.name != self.outcome.column]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type(), True) for f in self.fields])

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self.fields])

    def with_options(self, **changes) -> SourceContract:
        return replace(self, **changes)


# The column names, roles and markers of the public census income table.
CENSUS = SourceContract(
    fields=(
        Field("age", "int"),
        Field("workclass", "string"),
        Field("fnlwgt", "int"),
        Field("education", "string"),
        Field("education-num", "int"),
        Field("marital-status", "string"),
        Field("occupation", "string"),
        Field("relationship", "string"),
        Field("race", "string"),
        Field("sex", "string"),
        Field("capital-gain", "int", cap=99999),
        Field("capital-loss", "int"),
        Field("hours-per-week", "int"),
        Field("native-country", "string"),
        Field("income", "string"),
    ),
    outcome=Outcome("income", ">50K"),
)

# Columns of that table that are described but are not model features.
CENSUS_NOT_FEATURES = ("fnlwgt", "education")
CENSUS_NUMERIC_FEATURES = [c for c in CENSUS.numeric if c not in CENSUS_NOT_FEATURES]
CENSUS_CATEGORICAL_FEATURES = [c for c in CENSUS.categorical if c not in CENSUS_NOT_FEATURES]
