import random
import re
from collections import Counter

import numpy as np
import pytest

from mercato.llm.robust_rules import CUTOFF, FLOORS, H, chi_square_quantile, chi_square_tail, estimates, judged
from mercato.llm.rule_queries import robust_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words, seen, repeated_lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated_lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeated_lines, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def counts_of(r):
    return tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_query_counts_and_labels(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = robust_rules(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert counts_of(r) == brute_counts(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])
    judged_by_method = [(r["kept"], good[r["doc_id"]]) for r in rows if r["doc_id"] in good and not r["base_failed"]]
    assert all(kept for kept, y in judged_by_method if y == 1)
    assert sum(not kept for kept, y in judged_by_method if y == 0) >= 0.9 * sum(y == 0 for _, y in judged_by_method)


def test_chi_square():
    assert chi_square_tail(0, 4) == 1 and chi_square_tail(9.4877, 4) == pytest.approx(0.05, abs=1e-4)
    assert chi_square_quantile(0.05, 4) == pytest.approx(9.4877, abs=1e-3) and CUTOFF > 30


def test_a_third_of_outliers_does_not_move_the_estimate(spark):
    rnd = np.random.default_rng(2)
    clean = rnd.normal([1.6, 2, 3, 4], [0.2, 1, 1.5, 2], size=(1400, 4))
    dirty = rnd.normal([9, 9, 9, 9], 0.3, size=(350, 4))
    rows = [("g", x.tolist()) for x in np.concatenate([clean, dirty])] + [("alone", [1.0, 2.0, 3.0, 4.0])]
    got = {r["group"]: r for r in estimates(spark.createDataFrame(rows, "group string, x array<double>")).collect()}
    assert np.allclose(got["g"]["centre"], clean.mean(axis=0), atol=0.15)
    spread = np.linalg.inv(np.array(got["g"]["inverse"]).reshape(4, 4))
    want = np.cov(clean.T) + np.diag(np.square(FLOORS))
    assert np.allclose(np.diag(spread), np.diag(want), rtol=0.35)
    assert got["alone"]["centre"] == [1.0, 2.0, 3.0, 4.0]
    assert np.allclose(np.linalg.inv(np.array(got["alone"]["inverse"]).reshape(4, 4)), np.diag(np.square(FLOORS)))
    assert 0.5 < H < 1


@pytest.mark.parametrize("share", [0.26, 0.34])
def test_a_third_of_copies_is_rejected(spark, share):
    rnd = np.random.default_rng(4)
    clean = rnd.normal([1.6, 2, 1, 2], [0.1, 0.4, 0.5, 0.6], size=(1000, 4))
    junk = [[1.6, 7.0, 1.0, 2.0]] * round(1000 * share / (1 - share))
    rows = [("g", x) for x in clean.tolist() + junk]
    got = estimates(spark.createDataFrame(rows, "group string, x array<double>")).collect()[0]
    away = np.array([junk[0]] + clean.tolist()) - got["centre"]
    distances = np.einsum("ni,ij,nj->n", away, np.array(got["inverse"]).reshape(4, 4), away)
    assert distances[0] > CUTOFF and distances[1:].max() <= CUTOFF


def test_a_bad_source_with_a_third_of_copies(documents):
    rnd = random.Random(6)
    text = lambda: " ".join(f"word{rnd.randrange(10**6)}" for _ in range(60))
    bad = " ".join(f"w{i}#$%&" for i in range(60))
    rows = [(i, text() if i % 20 < 13 else bad, "en", "s") for i in range(400)]
    kept = {r["doc_id"]: r["kept"] for r in judged(documents(rows)).collect()}
    assert kept == {i: i % 20 < 13 for i in range(400)}


def test_small_sources_are_pooled(documents):
    rnd = random.Random(3)
    text = lambda: " ".join(f"word{rnd.randrange(10**6)}" for _ in range(60))
    rows = [(i, text(), "en", f"s{i % 40}") for i in range(240)] + [(i, text(), "xx", None) for i in range(300, 305)]
    rows += [(900, " ".join(f"w{i}#$%&" for i in range(60)), "en", "s1"), (901, " ".join(f"w{i}#$%&" for i in range(60)), None, None)]
    kept = {r["doc_id"]: r["kept"] for r in judged(documents(rows)).collect()}
    assert not kept.pop(900) and not kept.pop(901) and all(kept.values())


def test_awkward_rows(awkward, nothing):
    rows = judged(awkward).collect()
    texts = sorted((brute_counts(r["text"]) for r in awkward.collect()))
    assert sorted(counts_of(r) for r in rows) == texts
    assert {r["kept"] for r in rows if r["base_failed"]} == {False}
    assert judged(nothing).count() == 0
