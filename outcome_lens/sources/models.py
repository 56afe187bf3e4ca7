"""Fitted models on disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError, col


def save_model(model: PipelineModel, path: str) -> None:
    try:
        model.write().overwrite().save(path)
    except Exception as error:
        raise AnalysisError(f"cannot save the model to {path}: {error}") from error


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise AnalysisError(f"cannot load a model from {path}: {error}") from error


def save_and_verify(model: PipelineModel, df: DataFrame, path: str) -> DataFrame:
    """Save, load back, and predict every row with both; more than 0 mismatches is an error.

    Both models run over the same row, so no key and no join is needed to compare them.
    """
    save_model(model, path)
    again = load_model(path)

    def predicted(m: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
        out = m.transform(rows)
        return out.select(*[col(c) for c in rows.columns], F.col("prediction").alias(name))

    both = predicted(again, predicted(model, df, "_kept"), "_loaded")
    result = both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("_kept").eqNullSafe(F.col("_loaded"))).alias("mismatches"),
    )
    row = result.first()
    if row["mismatches"]:
        raise AnalysisError(f"the loaded model predicts {row['mismatches']} of {row['rows']} rows differently")
    return df.sparkSession.createDataFrame([row], result.schema)
