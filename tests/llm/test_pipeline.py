import re

import corpus_pipeline
from tokenizers import Tokenizer

from mercato.llm.class_queries import quality
from mercato.llm.decontaminate import words_of
from mercato.llm.token_queries import BYTE_FILE, tokenizer_path

from test_minhash_forest import brute


def test_rows_equal_a_brute_force_version(spark):
    """Quality by the classifier's own scores, the other stages by plain Python over all pairs."""
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [" ".join(words_of(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    good = {r["doc_id"]: docs[r["doc_id"]] for r in quality(spark, sf_dir).collect() if r["predicted"]}
    classes = brute(list(good.items()))
    first = {i: t for i, t in good.items() if classes[i][1] == i}
    clean = {i: t for i, t in first.items() if not any(f" {w} " in f" {' '.join(words_of(t))} " for w in items)}
    masked = {i: re.sub(r'(?i)(token = ")[0-9a-f]{40}', r"\1[SECRET]", t) for i, t in clean.items()}
    library = Tokenizer.from_file(tokenizer_path(BYTE_FILE))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in masked.items()}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert len(docs) > len(good) > len(first) > len(clean) and any(masked[i] != clean[i] for i in clean)
    assert {i: r["ids"] for i, r in got.items()} == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got.values())


def test_stages_keep_columns_and_survive_awkward_rows(spark, awkward, nothing, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "secrets", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        for docs in (awkward, nothing):
            out = stage(spark, docs, sf_dir)
            rows = out.collect()
            if name != "bpe":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            if name == "near_dedup" and docs is awkward:
                ids = [r["doc_id"] for r in rows]
                assert ids.count(7) == 1 and 5 not in ids and 4 in ids and ids.count(None) == 2
            if name in ("decontaminate", "secrets", "bpe"):
                assert len(rows) == docs.count()
            if docs is nothing:
                assert not rows


def test_rows_of_one_id_with_different_texts_are_different_documents(spark, tmp_path):
    a, b, q, e = (" ".join(f"{name}{i}" for i in range(40)) for name in ("alpha", "beta", "quill", "east"))
    leak = "the rare test question that nobody should ever have trained on"
    given = [(1, a), (2, a), (2, b), (5, q), (5, e), (5, e), (3, q + " more"), (7, None), (7, ""), (8, f"{leak} {b.upper()[:60]}"), (8, f"so {leak} and so on")]
    docs = spark.createDataFrame([(i, t, "en", "web", 1, "x") for i, t in given],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    # 5 = q is a copy of 3, which has its id to itself.
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] < 6) == sorted(
        [(1, a), (2, b), (5, e), (3, q + " more")])
    assert kept.columns == docs.columns and sum(r["doc_id"] == 7 for r in kept.collect()) == 2
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    mixed = docs.replace({f"so {leak} and so on": "clean after all"}, subset=["text"])
    clean = corpus_pipeline.without_benchmark(spark, mixed, str(tmp_path))
    assert sorted(map(repr, clean.collect())) == sorted(repr(r) for r in mixed.collect() if leak not in (r["text"] or ""))
