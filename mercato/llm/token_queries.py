"""Token ids: byte-level BPE there and back, and token files."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.llm.byte_bpe import ByteBpe, encoded
from mercato.llm.catalog import query
from mercato.llm.store import table
from mercato.llm.token_files import read_tokens, write_tokens
from mercato.llm.word_tokens import WordTokens, vocabulary
from mercato.session import scratch_path

WORD_FILE, BYTE_FILE, END_ID = "word_bpe_49k.json", "byte_bpe_50k.json", 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_token_files")
def token_files(spark, sf_dir):
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, WordTokens(vocabulary(tokenizer_path(WORD_FILE))), END_ID)
    return read_tokens(spark, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def bpe_digests(docs, bpe):
    made = encoded(docs, bpe, decode=True)
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_bpe_round_trip")
def bpe_round_trip(spark, sf_dir):
    return bpe_digests(table(spark, sf_dir, "documents"), ByteBpe(vocabulary(tokenizer_path(BYTE_FILE))))
