import random

import numpy as np

from mercato.llm.links import components
from mercato.llm.words import WordNumbers, shingle_set, split_words


def brute_components(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {x: root(x) for x in parent if root(x) != x}


def test_components_of_chains_stars_and_noise(spark):
    rnd = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [(900, 900), (901, 900), (900, 901)]
    pairs += [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)]
    rnd.shuffle(pairs)
    links = spark.createDataFrame(pairs + [(None, 3), (4, None)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(links).collect()} == brute_components(pairs)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_split_at_ascii_blanks_only():
    assert split_words("A\x0bB\x0cÉ\x85x\xa0y \x1cZ") == ["a".encode(), b"b", "É\x85x\xa0y".encode(), b"\x1cz"]
    assert split_words(None) == split_words(" \n") == []


def test_shingle_sets():
    numbers = WordNumbers()
    made = lambda text: shingle_set(split_words(text), numbers, 5)
    assert len(made("")) == 0 and len(made("a b")) == 1 and len(made("a b c d e f")) == 2
    assert len(made("a a a a a a a")) == 1
    assert not np.intersect1d(made("a b c"), made("a b c d e")).size
    assert np.array_equal(made("A b"), made("a  B"))
