"""Training-corpus pipeline over ``documents``.

``STAGES`` lists (name, function) in order.  A function takes (spark, docs,
sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads
again as the next one's docs.  All but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.langid_zstd import identify, learn
from tierflow.llm.minhash_dart import drop_near_duplicates
from tierflow.llm.mixing import mix_sources
from tierflow.llm.spm_prefix import encode_texts
from tierflow.llm.stages import staged
from tierflow.llm.substring_dedup import dedup_substrings

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; ``lang`` becomes the one found.
    Null texts, texts without a letter and those of narrow margins go."""
    found = identify(docs, learn(docs)).where("not rejected")
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; those of which
    nothing is left go."""
    kept = dedup_substrings(docs).where("text <> ''")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: documents as often as it takes them."""
    taken = mix_sources(docs).where("copies > 0")
    return taken.withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and a digest of the ids decoded
    again."""
    return encode_texts(docs, MODEL, ("n_tokens", "ids", "decoded_sha256")).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix),
    ("SentencePiece encoding", tokens),
]

#: SQL can't express dictionaries, signatures or token merges: the stages are
#: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return docs
