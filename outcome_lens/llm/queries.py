"""The operators of this subpackage over the test tables, and the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outcome_lens.llm import alignment, class_model, collocations, contamination, main_text, mixing, near_duplicates, perplexity, personal_data, token_ids, toxicity, url_rules, warc
from outcome_lens.session import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_bpe() -> str:
    """Where the tokenizer file of the token-id query is: a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    """Where the second tokenizer of the alignment is."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, toxicity.learn(docs, table(spark, folder, "labels")))


@query
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op5_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    token_ids.write_token_ids(table(spark, folder, "documents"), path, byte_bpe())
    return token_ids.document_positions(spark, path)


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality(table(spark, folder, "documents"))


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judged(table(spark, folder, "pages"))


@query
def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(table(spark, folder, "pages"))


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"), byte_bpe(), piece_bpe())


@query
def op13_class_scores(spark: SparkSession, folder: str) -> DataFrame:
    return class_model.class_scores(table(spark, folder, "documents"))


SQL["op11_collocations"] = collocations.collocations_sql()
SQL["op9_url_filters"] = url_rules.judged_sql()
SQL["op8_warc"] = """
SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
  CASE WHEN octet_length(encode(coalesce(html, ''))) >= 100 AND page_id <> min(page_id) OVER same THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(encode(coalesce(html, ''))) >= 100 AND page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))"""
