"""The training-data pipeline over ``documents``: each stage reads what the stage before it wrote.

Toxic documents go; of every class of near-duplicates the document with the smallest id stays;
contaminated documents go, and single benchmark passages are cut out of the others; the sources are mixed to their
target weights, a text standing once for each time it is taken; the mix is written as token ids, and
the last stage returns where each of its texts stands in the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from outcome_lens.llm import contamination, mixing, near_duplicates, token_ids, toxicity
from outcome_lens.llm.queries import byte_bpe, table
from outcome_lens.session import new_path, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the labelled rows of the tables, not from what the stage filters."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "pipeline-token-ids")
    token_ids.write_token_ids(docs, folder, byte_bpe())
    return token_ids.document_positions(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]
# A learned lexicon, signatures, an automaton and a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
