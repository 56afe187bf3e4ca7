"""The model's columns: scaled numbers, and one 0/1 column per level other than the reference."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, Outcome, col
from outcome_lens.functions.columns import number, require, to_rows
from outcome_lens.functions.ordering import running_totals
from outcome_lens.operators.levels import level_counts
from outcome_lens.session import stored

# Columns a model may have: its normal equations are a square matrix of this size on the driver.
MAX_FEATURES = 2000
NUMERIC_CONTRAST = "1 SD"
GROUPING_PAYS = 20  # rows per combination from which equal rows are counted together


def fit_scaler(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Rows ``(column, n, mean, sd_pop, scale)``; a constant column is scaled by 1, not by 0."""
    require(df, *numeric)
    one = df.agg(
        *[
            F.struct(
                F.lit(n).alias("column"),
                F.count(number(df, n)).alias("n"),
                F.avg(number(df, n)).alias("mean"),
                F.stddev_pop(number(df, n)).alias("sd_pop"),
            ).alias(f"_{i}")
            for i, n in enumerate(numeric)
        ]
    )
    rows = one.select(F.explode(F.array(*[f"_{i}" for i in range(len(numeric))])).alias("_e")).select("_e.*")
    return rows.withColumn("scale", F.when(F.col("sd_pop") == 0, 1.0).otherwise(F.col("sd_pop")))


def fit_encoder(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Rows ``(column, level, n, slot, is_reference)``; slot 0 is the reference, the rest go by name.

    A column may have any number of levels: slots are running totals over the counted levels, and nothing of
    them comes to the driver.
    """
    counts = stored(level_counts(df, categorical), "level-counts")
    most = F.min(F.struct((-F.col("n")).alias("n"), "level")).alias("most")
    reference = counts.groupBy("column").agg(most).select("column", F.col("most.level").alias("reference"))
    marked = counts.join(reference, "column").select("column", "level", "n", (F.col("level") == F.col("reference")).alias("is_reference"))
    order = [F.col("is_reference").desc(), F.col("level").asc()]
    placed = running_totals(marked, ["column"], order, {"_place": F.lit(1).cast("long")})
    return placed.select("column", "level", "n", (F.col("_place") - 1).alias("slot"), "is_reference")


@dataclass(frozen=True)
class Design:
    """What was learned from the training rows about the model's columns."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    outcome: Outcome
    rows: int
    positives: int
    distinct: int  # about how many different combinations of features and label the rows hold
    means: dict[str, float]
    scales: dict[str, float]
    levels: dict[str, tuple[tuple[str, int], ...]]  # reference first, then by name

    @property
    def features(self) -> list[tuple[str, str | None]]:
        """``(feature, level)`` per model column, in vector order; the level of a number is None."""
        dummies = [(c, level) for c in self.categorical for level, _ in self.levels[c][1:]]
        return [(n, None) for n in self.numeric] + dummies

    @property
    def reference(self) -> dict[str, tuple[str, int]]:
        return {c: self.levels[c][0] for c in self.categorical if self.levels[c]}


def display_name(feature: str, level: str | None) -> str:
    return feature if level is None else f"{feature}_{level}"


def _moments(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], outcome: Outcome, by: Sequence[str] = ()
) -> list[Row]:
    """Rows, positives, and per number its count, mean and population variance, in one scan."""
    combination = F.xxhash64(*[col(n) for n in [*numeric, *categorical]], outcome.flag())
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct(combination).alias("distinct"),
            F.coalesce(F.sum(outcome.flag()), F.lit(0)).alias("positives"),
            *[F.count(number(df, n)).alias(f"n{i}") for i, n in enumerate(numeric)],
            *[F.avg(number(df, n)).alias(f"mean{i}") for i, n in enumerate(numeric)],
            *[F.var_pop(number(df, n)).alias(f"var{i}") for i, n in enumerate(numeric)],
        )
        .collect()
    )


def _level_rows(counts: DataFrame, limit: int) -> list[Row]:
    found = counts.limit(limit + 1).collect()
    if len(found) > limit:
        raise AnalysisError(f"the categorical columns have more than {MAX_FEATURES} levels together")
    return found


def _combined(
    moments: Sequence[Row], levels: Sequence[Row], numeric: Sequence[str], categorical: Sequence[str], outcome: Outcome
) -> Design:
    """A design from the facts of any number of disjoint parts of the training rows."""
    means, scales = {}, {}
    for i, name in enumerate(numeric):
        parts = [(m[f"n{i}"], m[f"mean{i}"], m[f"var{i}"]) for m in moments if m[f"n{i}"]]
        n = sum(p[0] for p in parts)
        if n == 0:
            raise AnalysisError(f"{name} has no value in the training rows")
        mean = math.fsum(p[0] * p[1] for p in parts) / n
        var = math.fsum(p[0] * (p[2] + (p[1] - mean) ** 2) for p in parts) / n
        means[name], scales[name] = mean, math.sqrt(var) or 1.0  # a constant column is scaled by 1
    counts: dict[str, Counter] = {c: Counter() for c in categorical}
    for r in levels:
        counts[r["column"]][r["level"]] += r["n"]
    ordered = {}
    for c, found in counts.items():
        reference = min(found, key=lambda level: (-found[level], level), default=None)
        ordered[c] = tuple((level, found[level]) for level in sorted(found, key=lambda v: (v != reference, v)))
    return Design(
        numeric=tuple(numeric),
        categorical=tuple(categorical),
        outcome=outcome,
        rows=sum(m["rows"] for m in moments),
        positives=sum(m["positives"] for m in moments),
        distinct=sum(m["distinct"] for m in moments),
        means=means,
        scales=scales,
        levels=ordered,
    )


def fit_design(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], outcome: Outcome
) -> Design:
    """Learn scales and levels in two scans; only these bounded facts come to the driver."""
    require(df, *numeric, *categorical, outcome.column)
    if not [*numeric, *categorical]:
        raise AnalysisError("a model needs at least one feature")
    moments = _moments(df, numeric, categorical, outcome)
    if not moments[0]["rows"]:
        raise AnalysisError("no training rows")
    levels = _level_rows(level_counts(df, categorical), MAX_FEATURES) if categorical else []
    return _combined(moments, levels, numeric, categorical, outcome)


def fit_fold_designs(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], outcome: Outcome, fold: str, k: int
) -> list[Design]:
    """The design of each fold's training part, that is of all other folds, from two scans for all."""
    return fit_whole_and_folds(df, numeric, categorical, outcome, fold, k)[1]


def fit_whole_and_folds(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], outcome: Outcome, fold: str, k: int
) -> tuple[Design, list[Design]]:
    """The design of all rows, and those of ``fit_fold_designs``."""
    require(df, *numeric, *categorical, outcome.column, fold)
    moments = _moments(df, numeric, categorical, outcome, [fold])
    found = {m[fold] for m in moments}
    if found != set(range(k)):
        strange = sorted((f for f in found if f is not None and not 0 <= f < k), key=str)[:5]
        raise AnalysisError(
            f"folds must be exactly 0 to {k - 1}: others {strange}, rows without a fold: {None in found}, "
            f"folds without rows: {sorted(set(range(k)) - found)}"
        )
    levels: list[Row] = []
    if categorical:
        counts = (
            to_rows(df, categorical, keep=[fold])
            .filter(F.col("level").isNotNull())
            .groupBy(fold, "column", "level")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        levels = _level_rows(counts, MAX_FEATURES * k)
    designs = []
    for i in range(k):
        others = [m for m in moments if m[fold] != i]
        if not others:
            raise AnalysisError(f"fold {i} holds every row")
        designs.append(_combined(others, [r for r in levels if r[fold] != i], numeric, categorical, outcome))
    return _combined(moments, levels, numeric, categorical, outcome), designs


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def design_stages(design: Design, sample: DataFrame) -> list:
    """ML stages that add ``features``: SQL scaling, level index, 0/1 columns, reference cut off.

    A level that was not in training, and a missing one, has 0 in every column of its feature.
    """
    parts = ["*"]
    for i, n in enumerate(design.numeric):
        parts.append(f"(CAST({_quoted(n)} AS DOUBLE) - ({design.means[n]!r}D)) / {design.scales[n]!r}D AS __z{i}")
    for i, c in enumerate(design.categorical):
        parts.append(f"CAST({_quoted(c)} AS STRING) AS __c{i}")
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")]
    inputs = [f"__z{i}" for i in range(len(design.numeric))]
    coded = [i for i, c in enumerate(design.categorical) if len(design.levels[c]) > 1]
    if coded:
        # one indexer per column: labels of several columns would be padded to one length
        indexers = [
            StringIndexerModel.from_labels(
                [level for level, _ in design.levels[design.categorical[i]]],
                inputCol=f"__c{i}",
                outputCol=f"__i{i}",
                handleInvalid="keep",
            )
            for i in coded
        ]
        indexed = PipelineModel([*stages, *indexers]).transform(sample)
        encoder = OneHotEncoder(
            inputCols=[f"__i{i}" for i in coded], outputCols=[f"__o{i}" for i in coded], dropLast=False
        ).fit(indexed)
        stages += [*indexers, encoder]
        for i in coded:
            kept = list(range(1, len(design.levels[design.categorical[i]])))
            stages.append(VectorSlicer(inputCol=f"__o{i}", outputCol=f"__s{i}", indices=kept))
            inputs.append(f"__s{i}")
    if not inputs:
        raise AnalysisError("no feature varies: every categorical column has one level")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def encode(df: DataFrame, design: Design) -> DataFrame:
    """``df`` with the sparse ``features`` vector added; a column of that name is an error."""
    refuse_taken(df, ["features"])
    done = PipelineModel(design_stages(design, df)).transform(df)
    return done.select(*[col(c) for c in df.columns], "features")


INTERNAL = re.compile("__[zcios][0-9]+", re.IGNORECASE)  # the columns of the stages above


def refuse_taken(df: DataFrame, names: Sequence[str]) -> None:
    """An error if ``df`` has a column that would be overwritten."""
    made = {n.lower() for n in names}
    taken = [c for c in df.columns if c.lower() in made or INTERNAL.fullmatch(c)]
    if taken:
        raise AnalysisError(f"columns {taken} have names of columns that are added here: rename them")


def model_rows(df: DataFrame, design: Design, keep: Sequence[str] = ()) -> DataFrame:
    """What a model reads of ``df``: its columns, ``_label``, and ``_rows``, the copies a row stands for.

    The loss of equal rows is that of one row times their number, so they are counted together where
    that shrinks the table far enough to pay for the shuffle. Every pass of a solver, and every
    score, is then over the combinations and not over the rows. The result is the same either way.
    """
    names = list(dict.fromkeys([*design.numeric, *design.categorical, *keep]))
    rows = df.select(*[col(n) for n in names], design.outcome.flag().alias("_label"))
    if not grouping_pays(design):
        return rows.withColumn("_rows", F.lit(1).cast("long"))
    return rows.groupBy(*[col(n) for n in names], "_label").agg(F.count(F.lit(1)).alias("_rows"))


def grouping_pays(design: Design) -> bool:
    return design.distinct * GROUPING_PAYS <= design.rows


def design_metadata(df: DataFrame, design: Design) -> DataFrame:
    """Rows ``(slot, feature, level, name, contrast, is_dropped)``; dropped rows are the references."""
    rows = [
        (
            k,
            feature,
            level,
            display_name(feature, level),
            NUMERIC_CONTRAST if level is None else f"{feature}={design.reference[feature][0]}",
            False,
        )
        for k, (feature, level) in enumerate(design.features)
    ]
    rows += [(None, c, level, display_name(c, level), None, True) for c, (level, _) in design.reference.items()]
    schema = "slot int, feature string, level string, name string, contrast string, is_dropped boolean"
    return df.sparkSession.createDataFrame(rows, schema)
