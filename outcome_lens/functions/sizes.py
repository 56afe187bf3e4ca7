"""Small results on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from outcome_lens.contract import AnalysisError

MOST_SETTLED = 1_000  # rows of a result that is a table of metrics


def settled(df: DataFrame) -> DataFrame:
    """A result of a fixed few rows, computed now: whatever uses it later does not run its plan again."""
    rows = df.limit(MOST_SETTLED + 1).collect()
    if len(rows) > MOST_SETTLED:
        raise AnalysisError(f"a result of more than {MOST_SETTLED} rows is no table of metrics")
    return df.sparkSession.createDataFrame(rows, df.schema)
