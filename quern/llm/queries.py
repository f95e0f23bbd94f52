"""The dealt operators as registered queries, with their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import (
    ann_forest, chunk_dedup, conversation_trie, hard_negatives, langid, length_packing, license_scan, minmax, mixing, piece_encode, token_dp, token_store, url_trees)
from quern.llm.common import table


def _vocabulary(name: str) -> str:
    """Where the public tokenizer file lies (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_crf_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seen = langid.predict(docs, langid.fit(docs))
    return seen.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "n_words")


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.assign(table(spark, sf_dir, "documents").select("doc_id", "text", "source")))


def op3_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_dp.zipf_scores(token_dp.ranked_pieces(_vocabulary("piece_bpe_32k.model")))
    return token_dp.token_counts(table(spark, sf_dir, "documents"), scores)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.new_path(spark)
    token_store.write(table(spark, sf_dir, "documents"), path, _vocabulary("word_bpe_49k.json"), end_id=1)
    return token_store.read_digest(spark, path)


def op5_piece_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encode.digest(piece_encode.encode_table(
        table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op7_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(table(spark, sf_dir, "embeddings"), k=5)


def op10_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(table(spark, sf_dir, "pages"))


def op11_monoid_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations")).drop("turn_conv_id", "turn_pos")


def op12_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = length_packing.pieces(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))
    return length_packing.digest(length_packing.pack(encoded))


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(rows, label=hard_negatives.relabel(rows["vec_id"], rows["label"]))


QUERIES = {f.__name__: f for f in (
    op1_crf_langid, op2_curriculum_mix, op3_trie_token_counts, op4_token_store, op5_piece_encode, op6_license_scan,
    op7_minmax_neardup, op8_chunk_recipes, op9_prefix_forest, op10_url_trees, op11_monoid_prefix_trie,
    op12_length_packing, op13_threshold_negatives)}

ORACLES = {
    "op8_chunk_recipes": chunk_dedup.ORACLE,
    "op11_monoid_prefix_trie": conversation_trie.ORACLE,
    "op13_threshold_negatives": hard_negatives.ORACLE,
}
