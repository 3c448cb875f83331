import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from mercato.llm.byte_bpe import ByteBpe, encoded
from mercato.llm.token_files import pack, read_tokens, unpack, write_tokens
from mercato.llm.token_queries import BYTE_FILE, END_ID, WORD_FILE, bpe_round_trip, token_files, tokenizer_path
from mercato.llm.word_tokens import WordTokens, vocabulary
from mercato.session import scratch_path

LETTERS = [*"aZé'sİß.,!?ñ0 9\t\n\x1c\x85\xa0\u2028 e\u0301<|>Σς가ᄀ中#$😀_\x0b\x0c\r\x00", "<|endoftext|>", "<|startoftext|>",
           "'ll", "don't", "  ", "the", " and", "\n\n"]


def fuzz(count):
    rnd = random.Random(8)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 40))) for _ in range(count)]


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(vocabulary(tokenizer_path(BYTE_FILE)))


@pytest.fixture(scope="module")
def word_tokens():
    return WordTokens(vocabulary(tokenizer_path(WORD_FILE)))


def test_pack_and_unpack():
    rnd = np.random.default_rng(1)
    for _ in range(100):
        ids = rnd.integers(0, 2 ** int(rnd.integers(1, 33)), int(rnd.integers(0, 50)), dtype=np.uint64).astype(np.uint32)
        control, data = pack(ids)
        assert len(control) == -(-len(ids) // 4) and np.array_equal(unpack(control, data, len(ids)), ids)


def test_columns_of_texts_are_split_by_distinct_words(word_tokens):
    import pyarrow as pa

    texts = ["", " ", " the end ", "the\x0bthe\x0c\tthe\n", "end\x1cend\x85 the\xa0end", *fuzz(300), "the end"]
    library = Tokenizer.from_file(tokenizer_path(WORD_FILE))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in word_tokens.encode_column(pa.array(texts, pa.large_string()))] == want
    assert [i.tolist() for i in word_tokens.encode_column(pa.array(texts, pa.large_string()).slice(2, 9))] == want[2:11]
    assert word_tokens.encode_column(pa.array([], pa.large_string())) == []


def test_word_tokens_equal_the_library(word_tokens):
    texts, library = fuzz(3000), Tokenizer.from_file(tokenizer_path(WORD_FILE))
    assert [i.tolist() for i in word_tokens.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_byte_bpe_equals_the_library(bpe):
    texts = fuzz(3000) + ["a" * 5000, "ab" * 3000 + "é" * 500, " " * 3000, "x" * 33, "𝔘" * 50, "0" * 999]
    library = Tokenizer.from_file(tokenizer_path(BYTE_FILE))
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = bpe.encode(text)
        assert ids.tolist() == want.ids
        assert bpe.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == text


def test_certain_cuts_are_inside_no_token(bpe):
    for data in list(bpe.token_bytes.values())[:50256:97]:
        view = np.frombuffer(data, np.uint8)
        assert not bpe.never[view[:-1], view[1:]].any()
    assert bpe.never[ord("e"), ord(" ")]


def test_bpe_query(spark, sf_dir):
    library = Tokenizer.from_file(tokenizer_path(BYTE_FILE))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = bpe_round_trip(spark, sf_dir).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_token_files_query(spark, sf_dir):
    library, start = Tokenizer.from_file(tokenizer_path(WORD_FILE)), 0
    got = {r["doc_id"]: r for r in token_files(spark, sf_dir).collect()}
    for row in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = library.encode(row["text"], add_special_tokens=False).ids + [END_ID]
        r = got.pop(row["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_awkward_rows(spark, awkward, nothing, bpe, word_tokens):
    got = encoded(awkward, bpe, decode=True).collect()
    assert len(got) == awkward.count()
    assert sorted(r["decoded"] for r in got) == sorted(r["text"] or "" for r in awkward.collect())
    folder = scratch_path(spark, "tokens-test")
    write_tokens(awkward, folder, word_tokens, END_ID)
    back = sorted(read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in back]
    assert ids == [None, None] + sorted(r["doc_id"] for r in awkward.collect() if r["doc_id"] is not None)
    assert all(np.frombuffer(r["ids"], "<u4")[-1] == END_ID for r in back)
    ends = [r["start"] + len(r["ids"]) // 4 for r in back]
    assert [r["start"] for r in back] == [0, *ends[:-1]]
    empty = scratch_path(spark, "tokens-test")
    write_tokens(nothing, empty, word_tokens, END_ID)
    assert read_tokens(spark, empty).count() == 0
    assert encoded(nothing, bpe).count() == 0
