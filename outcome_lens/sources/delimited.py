"""Reading delimited files under a contract, and turning raw strings into typed columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcome_lens.contract import AnalysisError, Field, SourceContract, col
from outcome_lens.functions.columns import require


def _scan(spark: SparkSession, path: str, contract: SourceContract, schema: T.StructType, **more) -> DataFrame:
    options = {"sep": contract.delimiter, "comment": contract.comment, "mode": "FAILFAST", "header": "false", **more}
    try:
        return spark.read.options(**options).schema(schema).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise AnalysisError(f"no data file at {path}") from None
        raise AnalysisError(f"cannot read {path}: {error}") from error


def read_contract(spark: SparkSession, path: str, contract: SourceContract) -> DataFrame:
    """A typed scan: trimmed, null token as NULL, comment lines skipped, label suffix removed.

    A line that starts with the comment mark is skipped whole; the mark inside a line is data.
    A cell that does not fit its type fails the job that reads it.
    """
    df = _scan(
        spark,
        path,
        contract,
        contract.schema(),
        nullValue=contract.null_token,
        ignoreLeadingWhiteSpace="true",
        ignoreTrailingWhiteSpace="true",
    )
    label = contract.outcome.column
    kind = {f.name: f.kind for f in contract.fields}[label]
    columns = [
        F.rtrim(col(n), F.lit(contract.label_suffix)).alias(n)
        if n == label and kind == "string" and contract.label_suffix
        else col(n)
        for n in contract.names
    ]
    return df.select(*columns)


def read_raw(spark: SparkSession, path: str, contract: SourceContract) -> DataFrame:
    """Every column as the string that lies in the file; ``normalise`` gives it its types."""
    return _scan(spark, path, contract, contract.raw_schema())


LINE = "line"  # of a malformed line as it stands in the file; null for others


def read_lines(spark: SparkSession, path: str, contract: SourceContract) -> DataFrame:
    """``read_raw`` that lets malformed lines through: ``line`` holds those with too few or too many cells.

    ``file`` and ``block`` say which file a row is from, and where in it the part starts that one task read.
    """
    taken = {LINE, "file", "block", "failed_columns", "reason"} & set(contract.names)
    if taken:
        raise AnalysisError(f"the contract has columns named {', '.join(sorted(taken))}, which are added here")
    schema = T.StructType([*contract.raw_schema().fields, T.StructField(LINE, T.StringType())])
    df = _scan(spark, path, contract, schema, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def read_quarantined(spark: SparkSession, path: str, contract: SourceContract) -> tuple[DataFrame, DataFrame]:
    """``(typed, rejected)``: every line with a cell is in one of them.

    ``rejected`` has the raw strings, ``failed_columns``, ``reason`` (``line`` for a malformed one, else ``cells``), the
    malformed ``line``, and its ``file`` and ``block``. No row fails the job.
    """
    raw = read_lines(spark, path, contract)
    some = reduce(lambda a, b: a | b, [col(n).isNotNull() for n in contract.names], F.col(LINE).isNotNull())
    marked = raw.filter(some).withColumn("failed_columns", _failed(contract))
    good = F.col(LINE).isNull() & (F.size("failed_columns") == 0)
    typed = marked.filter(good).select(*[_cleaned(f, contract).try_cast(f.spark_type()).alias(f.name) for f in contract.fields])
    reason = F.when(F.col(LINE).isNotNull(), F.lit("line")).otherwise(F.lit("cells"))
    return typed, marked.filter(~good).withColumn("reason", reason)


def _failed(contract: SourceContract) -> Column:
    """The names of the cells of a raw row that do not cast."""
    bad = [
        F.when(_cleaned(f, contract).isNotNull() & _cleaned(f, contract).try_cast(f.spark_type()).isNull(), F.lit(f.name))
        for f in contract.fields
    ]
    return F.array_compact(F.array(*bad))


def _cleaned(field: Field, contract: SourceContract) -> Column:
    # an empty field and the null token are the only two ways to write a missing cell
    text = F.nullif(F.nullif(F.trim(col(field.name)), F.lit(contract.null_token)), F.lit(""))
    if field.name == contract.outcome.column and contract.label_suffix:
        text = F.rtrim(text, F.lit(contract.label_suffix))
    return text


def normalise(
    df: DataFrame, contract: SourceContract, on_error: str = "fail"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Trim, null the token, strip the label suffix, cast; rows without any cell are dropped.

    ``on_error="fail"`` casts strictly. ``"quarantine"`` returns ``(typed, rejected)``: a row with a
    cell that does not cast goes to ``rejected`` as raw strings, with the names of those cells.
    """
    if on_error not in ("fail", "quarantine"):
        raise AnalysisError(f"on_error is fail or quarantine, not {on_error!r}")
    require(df, *contract.names)
    raw = df.select(*[col(n) for n in contract.names]).na.drop("all")
    if on_error == "fail":
        return raw.select(
            *[_cleaned(f, contract).cast(f.spark_type()).alias(f.name) for f in contract.fields]
        )
    marked = raw.withColumn("failed_columns", _failed(contract))
    typed = marked.filter(F.size("failed_columns") == 0).select(
        *[_cleaned(f, contract).try_cast(f.spark_type()).alias(f.name) for f in contract.fields]
    )
    return typed, marked.filter(F.size("failed_columns") > 0)


@contextmanager
def parsing(path: str) -> Iterator[None]:
    """Wrap the action on a scan: a file that does not parse is reported as the domain error."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        text = str(error)
        if any(sign in text for sign in ("FAILED_READ_FILE", "MALFORMED", "CAST_INVALID_INPUT")):
            raise AnalysisError(f"cannot parse {path}: {text.splitlines()[0]}") from error
        raise
