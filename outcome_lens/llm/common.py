"""What several operators of this subpackage need."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcome_lens.session import stored

# Words of the contamination and near-duplicate rules, over text with A-Z lower-cased.
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(name: str = "text") -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def texts(docs: DataFrame) -> DataFrame:
    """The two columns that operators on documents read; all others, whatever their names, are left behind."""
    return docs.select(F.col("doc_id"), whole_text().alias("text"))


def words_of(text: str, pattern) -> list[str]:
    """``pattern``'s words of one text with A-Z lower-cased; other letters keep their case."""
    return pattern.findall(text.encode().lower().decode())


def give_back() -> None:
    """What this process has freed goes back to the system: Python workers outlive their tasks, and idle ones would keep it."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # not every C library has this
        ctypes.CDLL(None).malloc_trim(0)


def thrifty(work: Callable) -> Callable:
    """An Arrow function that gives back memory when it ends."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


SENT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"  # that go to a worker together


@contextmanager
def small_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs inside sends Python workers about ``most`` bytes at a time."""
    before = spark.conf.get(SENT_BYTES)
    spark.conf.set(SENT_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(SENT_BYTES, before)


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffle files behind the table go when it is written: nothing reads them any more."""
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        return stored(df, name)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
