"""Result tables, published together under one run id.

The tables of an attempt to write a run go to folders that no reader looks at. When all of them are complete, one
small file of a manifest names them, and only then the run, or its replacement, is there. A write that is killed
leaves the former run as it was.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError

FORMATS = ("parquet", "json")
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "run_id string, name string, attempt string, written long"


def write_results(
    results: Mapping[str, DataFrame], path: str, run_id: str, file_format: str = "parquet"
) -> None:
    """Each table goes to ``path/name/run_id=../attempt=..``; other tables and runs below ``path`` are left alone.

    All tables of a call appear at once, in place of those of the same names that the run had before.
    """
    if file_format not in FORMATS:
        raise AnalysisError(f"result format is one of {', '.join(FORMATS)}")
    if not results:
        return
    attempt = uuid.uuid4().hex
    for name, df in results.items():
        try:
            df.write.format(file_format).save(f"{path}/{name}/run_id={run_id}/attempt={attempt}")
        except Exception as error:
            raise AnalysisError(f"cannot write result {name} to {path}: {error}") from error
    spark = next(iter(results.values())).sparkSession
    before = _published(spark, path).filter((F.col("run_id") == run_id) & F.col("name").isin(list(results))).collect()
    rows = [(run_id, name, attempt, time.time_ns()) for name in results]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")
    for r in before:  # nobody looks at these any more
        _remove(spark, f"{path}/{r.name}/run_id={r.run_id}/attempt={r.attempt}")


def read_results(
    spark: SparkSession, path: str, name: str, run_id: str | None = None, file_format: str = "parquet"
) -> DataFrame:
    """One result table, over all published runs or for one; the run is a partition column."""
    found = _published(spark, path).filter(F.col("name") == name)
    if run_id is not None:
        found = found.filter(F.col("run_id") == run_id)
    folders = [f"{path}/{name}/run_id={r.run_id}/attempt={r.attempt}" for r in found.orderBy("run_id").collect()]
    if not folders:
        raise AnalysisError(f"no result {name} below {path}" + (f" of run {run_id}" if run_id is not None else ""))
    return spark.read.format(file_format).option("basePath", f"{path}/{name}").load(folders).drop("attempt")


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(run_id, name, written)``: which tables of which runs can be read, and when they were published."""
    return _published(spark, path).select("run_id", "name", F.timestamp_micros((F.col("written") / 1000).cast("long")).alias("written"))


def _published(spark: SparkSession, path: str) -> DataFrame:
    """The last attempt of each table of each run."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    last = rows.groupBy("run_id", "name").agg(F.max_by("attempt", "written").alias("attempt"), F.max("written").alias("written"))
    return last.select("run_id", "name", "attempt", "written")


def _remove(spark: SparkSession, folder: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
