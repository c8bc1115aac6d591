"""Queries of the llm operators over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import langid_zstd, url_logreg
from tierflow.llm.cws_fingerprint import compare_edited
from tierflow.llm.fim_chunks import fill_in_middle, restored
from tierflow.llm.html_suffix import extract_main_text
from tierflow.llm.jaccard_skip import jaccard_components
from tierflow.llm.minhash_dart import near_duplicates
from tierflow.llm.mixing import mix_sources
from tierflow.llm.spm_prefix import encode_texts
from tierflow.llm.substring_dedup import dedup_substrings
from tierflow.llm.topk_maxscore import quantized, top_k
from tierflow.llm.turn_repair import damaged, repair_conversations
from tierflow.llm.warc_salvage import read_archive, write_archive
from tierflow.session import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantized(_table(spark, sf_dir, "embeddings"))
    return top_k(rows.where("vec_id % 50 = 0"), rows, 5)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target",
                                    (F.col("size") * F.col("copies")).alias("taken"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid_zstd.held_out().alias("held_out"))
    dictionaries = langid_zstd.learn(docs.where("not held_out"))
    return langid_zstd.identify(docs.select("doc_id", "text", "held_out"), dictionaries).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_logreg.fit(url_logreg.labelled_urls(spark))
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_logreg.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "p_block")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, MODEL, ("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages"), path)
    page = lambda urn: F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).cast("long")
    return read_archive(spark, path).where("not gap").select(
        page("record_id").alias("page_id"), F.col("declared_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"))


def op8_cws_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_minhash_dart(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "is_first")


def op11_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(_table(spark, sf_dir, "conversations")))


def op12_fim_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_jaccard_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_maxscore": op1_topk_maxscore,
    "op2_mix_sources": op2_mix_sources,
    "op3_main_text": op3_main_text,
    "op4_language_id": op4_language_id,
    "op5_url_filter": op5_url_filter,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_warc": op7_warc,
    "op8_cws_fingerprint": op8_cws_fingerprint,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_minhash_dart": op10_minhash_dart,
    "op11_repair_turns": op11_repair_turns,
    "op12_fim_chunks": op12_fim_chunks,
    "op13_jaccard_skip": op13_jaccard_skip,
}
