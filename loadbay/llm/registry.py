"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadbay.llm import (
    decontaminate, language, licences, line_dedup, maintext, merkle, minhash, mixing, negatives, passages,
    tokenfile, topk, toxicity)
from loadbay.llm.ship import ship

import corpus_pipeline


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_t(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_t(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.mixed(mixing.described(_t(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")))
    return docs.selectExpr("doc_id", "_source AS source", "_lang AS lang", "mix_topic AS topic",
                           "_tokens AS n_tokens", "mix_prob AS prob", "mix_weight AS weight")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_t(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_items(
        _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(_t(spark, sf_dir, "pages"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(_t(spark, sf_dir, "documents"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(_t(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(_t(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_t(spark, sf_dir, "documents"))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return tokenfile.token_ids(_t(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_t(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_topk": op1_topk,
    "op2_line_dedup": op2_line_dedup,
    "op3_mixing": op3_mixing,
    "op4_language": op4_language,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_html_text": op7_html_text,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_licences": op9_licences,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_ids": op12_token_ids,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op1_topk": topk.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op3_mixing": mixing.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op9_licences": licences.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op13_hard_negatives": negatives.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
