import random
from collections import Counter

import numpy as np
import pytest

from mercato.llm import minhash_forest
from mercato.llm.minhash_forest import linked_pairs, near_duplicates

from test_links_and_words import brute_components


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    pairs = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and min(len(a), len(b)) * 4 >= max(len(a), len(b)) * 3:
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    pairs.append((i, j))
    lower = brute_components(pairs)
    return {i: (len(s), lower.get(i, i)) for i, s in sets}


def edited(rnd, words, share):
    return " ".join(rnd.choice("alpha beta gamma delta epsilon".split()) + str(rnd.randrange(99)) if rnd.random() < share else w
                    for w in words)


def check(docs, rows):
    got = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    return want


def test_matches_all_pairs_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_large_groups_of_copies_and_of_close_copies(spark, documents, monkeypatch):
    """Dense regions: hundreds of close copies of one text, exact copies of another, and a passage that many texts share."""
    monkeypatch.setattr(minhash_forest, "REGION", 6)
    monkeypatch.setattr(minhash_forest, "DEPTHS", ((3, 6), (4, 6), (6, 40), (9, 40), (12, None)))
    monkeypatch.setattr(minhash_forest, "BLOCK", 16)
    rnd = random.Random(5)
    base, other, shared = ([f"w{rnd.randrange(5000)}" for _ in range(n)] for n in (200, 120, 60))
    rows = [(i, edited(rnd, base, rnd.choice([0.002, 0.01, 0.02, 0.04]))) for i in range(1000, 1150)]
    rows += [(i, " ".join(other)) for i in range(2000, 2080)]
    rows += [(i, " ".join([f"u{rnd.randrange(10**6)}" for _ in range(100)] + shared)) for i in range(3000, 3060)]
    rnd.shuffle(rows)
    want = check(documents([(i, t, "en", "a") for i, t in rows]), rows)
    assert max(Counter(c for _, c in want.values()).values()) >= 80


def test_a_dense_region_over_the_limit_keeps_its_links(spark, documents, monkeypatch):
    """A template with one unique word each, in regions opened to the last depth, and texts at a similarity of about 0.76 to all."""
    monkeypatch.setattr(minhash_forest, "DEPTHS", ((3, 16), (4, 40), (6, 40), (9, 40), (12, None)))
    monkeypatch.setattr(minhash_forest, "BLOCK", 32)
    rnd = random.Random(8)
    template = [f"t{i}" for i in range(204)]
    core = [" ".join(template[:-1] + [f"only{i}"]) for i in range(300)]
    far = []
    for i in range(30):
        words, at = list(template), rnd.randrange(5, 170)
        for k in range(22):
            words[at + k] = f"e{i}x{k}"
        far.append(" ".join(words))
    rows = list(enumerate(core)) + [(1000 + i, t) for i, t in enumerate(far)]
    want = check(documents([(i, t, "en", "a") for i, t in rows]), rows)
    assert {c for _, c in want.values()} == {0}


def test_awkward_rows(awkward, nothing):
    got = near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for empty in (1, 2, 3):
        assert (by_id[empty]["n_shingles"], by_id[empty]["component_id"], by_id[empty]["kept"]) == (0, empty, True)
    assert by_id[5]["component_id"] == 4 and not by_id[5]["kept"]
    assert [r["kept"] for r in got if r["doc_id"] == 7] == [True, True]
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert near_duplicates(nothing).count() == 0


def test_block_products_give_all_links():
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.choice(60, rnd.integers(1, 50))).astype(np.uint64) for _ in range(80)]
    want = [(i, j) for i, a in enumerate(sets[:30]) for j, b in enumerate(sets[30:])
            if 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b))]
    assert sorted(linked_pairs(sets[:30], sets[30:])) == want and linked_pairs([], sets) == []


@pytest.mark.parametrize("depth", [1, 3, 12])
def test_trees_read_distinct_values_first(depth):
    orders = minhash_forest.orders()
    first = [tuple(o[:3]) for o in orders]
    assert len(set(sum(first, ()))) == minhash_forest.VALUES
    assert all(len(set(o)) == len(o) for o in orders)
    assert len({tuple(o[:depth]) for o in orders}) == minhash_forest.TREES
