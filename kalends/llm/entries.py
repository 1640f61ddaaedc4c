"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kalends.llm import sql
from kalends.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.repair import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.weak_quality import judge

    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op4_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.tree_bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.gru_lm import score

    return score(table(spark, sf_dir, "documents"))


def op6_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.severity import severities, train

    docs = table(spark, sf_dir, "documents")
    return severities(docs, train(docs, table(spark, sf_dir, "labels")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.cross_polytope import search

    return search(table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.simhash import near_copies

    return near_copies(table(spark, sf_dir, "documents"))


def op11_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.merkle_log import prove

    return prove(table(spark, sf_dir, "documents"))


def op12_max_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.max_sketch import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kalends.llm.range_join import near_copies

    return near_copies(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_repair, op2_warc, op3_weak_quality, op4_tree_bpe, op5_gru_lm, op6_severity, op7_token_counts, op8_packing, op9_cross_polytope, op10_simhash, op11_merkle_log, op12_max_sketch, op13_range_join, pipeline]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """Those that SQL can express; tests hold the other operators against brute force."""
    return {"op2_warc": sql.OP2_SQL, "op11_merkle_log": sql.OP11_SQL, "op12_max_sketch": sql.OP12_SQL, "op13_range_join": sql.OP13_SQL}
