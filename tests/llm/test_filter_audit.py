import random
import re
from itertools import permutations

import numpy as np
import pytest

from mercato.llm import byte_transducer
from mercato.llm.byte_transducer import COUNTS, Powers, counted, counts, distinct_words
from mercato.llm.filter_audit import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""), len(re.findall(r"[#$%&*|]", text or "")))


def brute_audit(rows, labels):
    texts = [(i, t or "", lang or "") for i, t, lang in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = []
    for i, t, _ in texts:
        n, distinct, capitals, points, symbols = brute_counts(t)
        copy = i is not None and any(j is not None and j < i and t == u for j, u, _ in texts)
        failed.append({f for f, y in zip("ABCDE", (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * points, symbols > 0, copy)) if y})
    out = set()
    for part in {lang for _, _, lang in texts}:
        held = [(i, f) for (i, _, lang), f in zip(texts, failed) if lang == part]
        steps, removed_in = [], {}
        for order in permutations("ABCDE"):
            left = held
            for step, own in enumerate(order, 1):
                gone = [x for x in left if own in x[1]]
                left = [x for x in left if own not in x[1]]
                fails = [f for _, f in held if own in f]
                removed_in[own] = removed_in.get(own, 0) + len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), len(fails) - len(gone), sum(f == {own} for f in fails),
                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), own))
        out |= {(*x[:-1], removed_in[x[-1]]) for x in steps}
    return out


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_counts_of_random_texts():
    rnd = random.Random(4)
    alphabet = ["a", "b", "A", "Z", "é", "中", "😀", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\xa0", "\x85", "#", "|", "*", "\x00", "\x1c"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.choice([0, 0, 1, 2, 5, 40, 400]))) for _ in range(600)]
    texts += [" ".join(["x" * 200, "x" * 199 + "y", "x" * 200, "x" * 65, "x" * 64, "x" * 64]), "a" * 100_000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    assert list(map(tuple, counts(data, offsets, Powers()))) == [brute_counts(t) for t in texts]


def test_words_of_one_hash_are_told_apart():
    class Flat(Powers):
        """All words hash alike, so only the bytes tell them apart."""

        def of(self, count):
            return np.zeros(count, np.uint64), np.zeros(count, np.uint64)

    words = [b"one", b"two", b"one", b"twelve letters", b"twelve lettere", b"twelve letters", b"y" * 80, b"y" * 79 + b"z"]
    data = np.frombuffer(b"".join(words) + bytes(8), np.uint8).copy()
    size = np.array([len(w) for w in words])
    begin = np.cumsum(size) - size
    owner = np.array([0, 0, 0, 0, 0, 0, 1, 1])
    assert distinct_words(data, begin, size, owner, 3, Flat()).tolist() == [4, 2, 0]


def test_blocks_of_any_size_agree(spark, awkward, monkeypatch):
    want = sorted(brute_counts(r["text"]) for r in awkward.collect())
    for size in (1, 100, 1 << 20):
        monkeypatch.setattr(byte_transducer, "BLOCK_BYTES", size)
        assert sorted(map(tuple, counted(awkward, ["doc_id"]).select(*COUNTS).collect())) == want


def test_against_brute_force(spark, documents):
    rnd = random.Random(9)
    texts = [None, "", " ", *[" ".join(rnd.choices(["a", "B", "cc", "d#", "long", *map(str, range(k))], k=n)) for k in (1, 300) for n in (3, 250, 300)]]
    rows = [(i if i % 11 else None, rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in range(1, 120)]
    rows += [(500, texts[3], "en"), (500, texts[3], "en"), (501, texts[4], "de")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(1, 100)] + [(None, 1, 1)]
    got = audit(documents([(i, t, lang, "s") for i, t, lang in rows]),
                spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.count() == 600 * 3
    assert {tuple(r) for r in got.select(*COLUMNS).collect()} == brute_audit(rows, labels)


@pytest.mark.parametrize("rows", ["awkward", "nothing"])
def test_awkward_and_empty(spark, request, rows):
    docs = request.getfixturevalue(rows)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {tuple(r) for r in audit(docs, labels).select(*COLUMNS).collect()}
    assert got == brute_audit([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], [])
