"""Equally long arrays of numbers, one packed block a task, brought together in a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 32  # partial sums of the middle level of the tree
BLOCK = "block binary"


def packed(values: np.ndarray) -> pa.RecordBatch:
    """One row with the numbers of ``values``; what a task of ``mapInArrow`` with the schema ``BLOCK`` yields once."""
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(values, "<f8").tobytes()], pa.binary())], names=["block"])


def tree_merge(blocks: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """All blocks merged, two at a time; None without any. The order of blocks is not fixed.

    Each task has sent one row, ``FAN_IN`` tasks merge these as they come in, and one merges what is left: what is
    shuffled does not depend on the number of pairs of columns or of rows, and no task holds more than two blocks.
    """

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch.column(0):
                values = np.frombuffer(cell.as_buffer(), "<f8")
                total = values.copy() if total is None else merge(total, values)
        if total is not None:
            yield packed(total)

    share = F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("share")
    some = blocks.select("block", share).repartition(FAN_IN, "share").select("block").mapInArrow(merged, BLOCK)
    rows = some.repartition(1).mapInArrow(merged, BLOCK).collect()
    return np.frombuffer(rows[0].block, "<f8").copy() if rows else None


def tree_sum(blocks: DataFrame) -> np.ndarray | None:
    """The sum of all blocks; None without any."""
    return tree_merge(blocks, np.add)
