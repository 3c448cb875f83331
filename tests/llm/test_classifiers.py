import random
import zlib

import numpy as np
import pytest

from mercato.llm import toxicity
from mercato.llm.boosted_trees import DEPTH, fit
from mercato.llm.class_queries import quality, toxicity as toxicity_query
from mercato.llm.quality import good_documents, quality_scores
from mercato.llm.toxicity import Features, fit as fit_linear, swapped, swaps, text_words, toxicity_scores

FOLD = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
NO_LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def sf_large():
    return "/root/testdata/sf0.01"


@pytest.mark.parametrize("query, label", [(quality, "quality"), (toxicity_query, "toxic")])
def test_held_out_documents(spark, sf_large, query, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf_large}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in query(spark, sf_large).collect()}
    assert set(got) == {r["doc_id"] for r in spark.read.parquet(f"{sf_large}/documents.parquet").collect()}
    least = 0.3 if label == "quality" else 0.5
    for i, r in got.items():
        assert r["held_out"] == FOLD(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least)
    held = [(got[i]["predicted"], y) for i, y in labels.items() if FOLD(i)]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)
    learnt = [(got[i]["predicted"], y) for i, y in labels.items() if not FOLD(i)]
    assert sum(p == y for p, y in learnt) >= 0.97 * len(learnt)


def test_trees_by_rows_and_by_arrays_agree():
    rnd = np.random.default_rng(3)
    rows = rnd.normal(size=(600, 4))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    trees = fit(rows, labels)
    assert ((trees.score(rows) > 0.5) == labels).mean() > 0.95
    for row in rows[:40]:
        margin = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            for _ in range(DEPTH):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += value[node]
        assert margin == pytest.approx(trees.margin(row[None])[0])


def test_trees_of_one_class_or_no_rows():
    assert fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == pytest.approx([1, 1], abs=1e-5)
    assert (fit(np.zeros((9, 3)), np.zeros(9)).score(np.ones((2, 3))) < 0.2).all()


def identity_rows(rnd, count):
    """Labelled sentences in which one identity term goes along with insults by chance of the sample."""
    plain = "walked home quietly after dinner with friends and talked about music weather travel books".split()
    rows = []
    for _ in range(count):
        toxic = rnd.random() < 0.5
        term = "women" if rnd.random() < (0.9 if toxic else 0.1) else "men"
        words = [term, *rnd.sample(plain, 8), *(rnd.sample(["idiots", "worthless", "trash"], 1) if toxic and rnd.random() < 0.7 else [])]
        rows.append((int(toxic), " ".join(words)))
    return rows


def trained(rows, fairness):
    features, pairs, made = Features(), swaps(), []
    for label, text in rows:
        words = text_words(text)
        other = swapped(words, pairs)
        made.append((label, *features.of(words), *(features.of(other) if other else (None, None))))
    weights, base = fit_linear(made, fairness=fairness)

    def score(text):
        ids, values = features.of(text_words(text))
        return 1 / (1 + np.exp(-(base + weights[ids] @ values)))

    return score


def test_swapping_identity_terms_hardly_changes_the_score():
    rows = identity_rows(random.Random(1), 400)
    neutral, swap = "women walked home quietly after dinner", "men walked home quietly after dinner"
    free, fair = trained(rows, 0.0), trained(rows, 1.0)
    assert abs(fair(neutral) - fair(swap)) < 0.2 * abs(free(neutral) - free(swap))
    assert fair(neutral) < free(neutral)
    assert fair("women idiots walked home quietly") > 0.5 and fair("men worthless trash walked home") > 0.5


def test_every_identity_term_is_swapped_inside_its_group():
    for group in toxicity.IDENTITIES:
        assert {swaps()[t] for t in group.split()} <= set(" ".join(toxicity.IDENTITIES).split())


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (6, 1, 0), (None, 1, 1), (7, None, None), (9, 0, 1), (404, 1, 1)], NO_LABELS)
    none = labels.limit(0)
    for scores in (quality_scores, toxicity_scores):
        got = scores(awkward, labels).collect()
        assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["held_out"] is False for r in got if r["doc_id"] is None)
        assert scores(nothing, labels).count() == 0
    assert {r["predicted"] for r in quality_scores(awkward, none).collect()} == {1}
    assert {r["predicted"] for r in toxicity_scores(awkward, none).collect()} == {0}
    kept = good_documents(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert good_documents(nothing, labels).count() == 0
