"""From raw documents to token ids, stage by stage; every stage is written as Parquet before the next one reads it.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs. The first four return the columns of docs. Null and
empty texts, ties and repeated rows are handled as each operator states. A row without an id can be dropped by the first
stage only, since the later ones name documents by id, or by id and text where rows of one id differ in text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.byte_bpe import ByteBpe, encoded
from mercato.llm.decontaminate import contaminated
from mercato.llm.minhash_forest import near_duplicates
from mercato.llm.quality import good_documents
from mercato.llm.secrets import redacted, scan
from mercato.llm.store import saved, table
from mercato.llm.token_queries import BYTE_FILE, tokenizer_path
from mercato.llm.word_tokens import vocabulary
from mercato.session import use_engine_conf


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def with_keys(docs: DataFrame, key: str) -> DataFrame:
    """docs with a column `key` that tells documents apart: the id, or where rows of one id differ in text a hash of both.

    Such hashes lie above 2^62, so documents with an id of their own come first. Equal rows share a key, a null id has none.
    Which ids clash is found from one hash a row, added up before the shuffle.
    """
    text = F.xxhash64("text", F.col("text").isNull())
    clash = docs.filter("doc_id is not null").groupBy(F.col("doc_id").alias(f"{key}_of")).agg(
        (F.min(text) != F.max(text)).alias("clash")).filter("clash").drop("clash")
    clash = saved(clash, "clash")
    own = F.col("doc_id").cast("long")
    if clash.isEmpty():
        return docs.withColumn(key, own)
    hashed = F.xxhash64("doc_id", "text", F.col("text").isNull()).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    marked = docs.join(clash, F.col("doc_id") == F.col(f"{key}_of"), "left")
    return marked.withColumn(key, F.when(F.col(f"{key}_of").isNull(), own).otherwise(hashed)).drop(f"{key}_of")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays, once.

    Rows without an id stay; texts without a word are in no group, of their repeated rows one stays as well. Rows of one id
    with different texts are different documents, which come after all others; among them the least hash stays.
    """
    key = f"key_{uuid.uuid4().hex}"
    keyed = with_keys(docs, key)
    judged = saved(near_duplicates(keyed, id_col=key), "judged")
    gone = judged.filter("not kept").select(F.col("doc_id").alias(key)).distinct()
    repeated = saved(judged.groupBy(F.col("doc_id").alias(key)).count().filter(f"{key} is not null and count > 1").select(key), "repeated")
    kept = keyed.join(gone, key, "left_anti")
    if repeated.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").unionByName(once).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows of one id with different texts are judged each."""
    key = f"key_{uuid.uuid4().hex}"
    keyed = with_keys(docs, key)
    leaks = contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    return keyed.join(saved(leaks.select(F.col("doc_id").alias(key)).distinct(), "leaks"), key, "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; the document stays, with the length of its new text."""
    findings = saved(scan(docs).filter("secret"), "secrets")
    masked = redacted(docs, findings)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every document that is left."""
    made = encoded(docs, ByteBpe(vocabulary(tokenizer_path(BYTE_FILE))))
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_quality),
    ("near_dedup", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", token_ids),
]

ORACLE_SQL = None  # trained models are not SQL; tests/llm compares run() with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(use_engine_conf(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
