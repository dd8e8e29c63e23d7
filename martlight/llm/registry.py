"""The registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.llm import conversations, decontaminate, fingerprints, licenses, mixing, negatives, pages, pieces, quality, sharding, simhash, suffixes, tokens
from martlight.llm.common import table
from martlight.session import work_path

END_ID = 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "tokens")
    tokens.write_tokens(table(spark, folder, "documents"), path, tokenizer_path(), END_ID, [F.col("doc_id").asc_nulls_first()])
    return tokens.read_tokens(spark, path)


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.tempered(docs))


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shard_documents(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"))


def op6_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = piece_model_path()
    return pieces.digests(pieces.decode(pieces.encode(table(spark, folder, "documents"), model), model))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = conversations.repaired(conversations.damaged(rows), rows.select("conv_id"))
    return found.where("repaired_sha256 IS NOT NULL").select("conv_id", *conversations.FIGURES, "audit", "repaired_sha256")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(table(spark, folder, "embeddings")), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op10_license_scan": licenses.scan_sql(), "op13_hard_negatives": negatives.mine_sql()}
