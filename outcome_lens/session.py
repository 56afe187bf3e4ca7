"""Session settings, and the shared folder that durable intermediate results go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from outcome_lens.contract import AnalysisError

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# the first width of a shuffle, and the size that adaptive execution joins partitions to
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_session(app: str = "outcome_lens", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators were tuned under. ``conf`` overrides any of them.

    Adaptive execution only joins shuffle partitions, it never adds any: on a cluster every shuffle therefore starts
    with the many partitions of ``CLUSTER_SETTINGS``, unless the cluster's own configuration says otherwise.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        for key, value in CLUSTER_SETTINGS.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without the setting: it gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise AnalysisError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="outcome_lens-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so that later jobs and retries read the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later steps read only the columns they need."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    _stored.append(path)
    return df.sparkSession.read.parquet(path)


_stored: list[str] = []  # tables of this driver that are still there


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are removed at the end: what is kept of them must have been written elsewhere."""
    before = len(_stored)
    try:
        yield
    finally:
        for path in _stored[before:]:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
        del _stored[before:]
