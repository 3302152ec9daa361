"""The registered queries opN_<name> over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skuweave.llm import decontamination, grammar, hard_negatives, merkle, mixing, ngram_join, personal_data, pieces, pivot_index, rule_quality, splitters, toxicity, weighted_sampling
from skuweave.llm.common import table


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"), mixing.QUERY_WEIGHTS)


def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitters.shard_by_splitters(table(spark, sf_dir, "documents"), shards=40)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), with_ids=False, digests=True)


def op3_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = grammar.token_file_path(spark)
    grammar.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    return grammar.read_token_files(spark, path)


def op5_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op6_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out_column(4, 2).alias("held_out"), "score", "predicted", "spans")


def op8_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = rule_quality.score_documents(docs, rule_quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out_column(5, 0).alias("held_out"), "score", "predicted")


def op9_pivot_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op4_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_poisson_mixing, op2_sentencepiece, op3_repair_token_files, op4_crf_personal_data, op5_weighted_sampling, op6_mil_toxicity, op7_ngram_jaccard,
        op8_rule_quality, op9_pivot_near_vectors, op10_sampled_splitters, op11_hard_negatives, op12_decontamination, op13_merkle_manifest,
    )
}
ORACLES = {
    "op1_poisson_mixing": mixing.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_decontamination": decontamination.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
