"""The queries of this package: each operator, with production parameters, on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine.llm import (
    alignment,
    decontaminate,
    fingerprints,
    html_extract,
    langid,
    line_templates,
    mixing,
    order_minhash,
    piece_encoding,
    sharding,
    spelling,
    token_blocks,
    token_counts,
)
from review_engine.llm.common import bounded, table
from review_engine.session import shared_path

Run = Callable[[SparkSession, str], DataFrame]

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"
END_ID = 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold = langid.fold_of(F.col("doc_id"))
    model = langid.fit(docs, learn=fold != 0)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents")).select("doc_id", "n_bytes", "depth", "shard_bytes", "shard")


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op4_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.drop_recurring_lines(table(spark, folder, "documents").select("doc_id", "text"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path(PIECES))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "token-blocks")
    token_blocks.write_blocks(table(spark, folder, "documents"), path, tokenizer_path(WORDS), END_ID)
    return token_blocks.read_blocks(spark, path)


def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id")


def op10_edit_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.classed(table(spark, folder, "documents"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.digests(table(spark, folder, "documents"), tokenizer_path(BYTES), tokenizer_path(PIECES))


def op12_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return piece_encoding.digests(docs, tokenizer_path(PIECES)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op13_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, folder, "documents"))


_ALL = (op1_language_id, op2_extendible_sharding, op3_html_extraction, op4_line_templates, op5_token_counts,
        op6_source_mix, op7_decontamination, op8_token_blocks, op9_order_minhash, op10_edit_fingerprints,
        op11_token_alignment, op12_piece_encoding, op13_spelling_groups)


def _prepared(run: Run) -> Run:
    return lambda spark, folder: run(bounded(spark), folder)


def runs() -> dict[str, Run]:
    return {run.__name__: _prepared(run) for run in _ALL}


def sqls() -> dict[str, str]:
    return {"op2_extendible_sharding": sharding.shard_sql(), "op4_line_templates": line_templates.SQL,
            "op13_spelling_groups": spelling.SQL}
