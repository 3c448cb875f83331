import random

import numpy as np

from mercato.llm.decontaminate import GAP, MATCH, MISMATCH, best_scores, contaminated, words_of

ITEMS = [(1, "The quick brown fox jumps over the lazy dog while eleven curious otters watch from a mossy riverbank at dusk."),
         (2, "Seven engineers measured the bridge, wrote down the load, and agreed that the northern cable must be replaced soon."),
         (2, "Seven engineers measured the bridge, wrote down the load, and agreed that the northern cable must be replaced soon."),
         (3, None), (4, "..."), (None, "no id for this item at all")]
FILL = [f"filler{i}" for i in range(400)]


def items(spark):
    return spark.createDataFrame([(*r, 1, "s") for r in ITEMS], "item_id long, text string, n long, score string")


def brute_score(a, b):
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (MATCH if x == y else MISMATCH), row[j + 1] + GAP, new[j] + GAP))
        row, best = new, max(best, max(new))
    return best


def test_alignment_equals_the_textbook():
    rnd = random.Random(2)
    pairs = [([rnd.randrange(6) for _ in range(rnd.randint(1, 12))], [rnd.randrange(6) for _ in range(rnd.randint(1, 30))])
             for _ in range(200)]
    got = best_scores([np.array(a) for a, _ in pairs], [np.array(b) for _, b in pairs])
    assert got.tolist() == [brute_score(a, b) for a, b in pairs]


def test_copies_edits_and_clean_texts(spark, documents):
    rnd = random.Random(3)
    words = words_of(ITEMS[0][1])
    around = lambda body: " ".join(FILL[:150]) + " " + body + " " + " ".join(FILL[150:])
    swapped = [w if i % 5 else f"changed{i}" for i, w in enumerate(words)]
    docs = documents([(i, t, "en", "a") for i, t in [
        (1, ITEMS[0][1]), (2, around(ITEMS[0][1].upper().replace(" ", "\n"))), (3, around(" ".join(swapped))),
        (4, around(" ".join(words[:9] + ["inserted", "here"] + words[9:]))), (5, around(" ".join(words[:3]))),
        (6, around(" ".join(rnd.sample(words, len(words))))), (7, ITEMS[1][1] + around("") + ITEMS[0][1] + " " + ITEMS[0][1]),
        (8, " ".join(FILL))]])
    for block in (1 << 20, 10):
        got = {(r["doc_id"], r["item_id"]): r["score"] for r in contaminated(docs, items(spark), block_bytes=block).collect()}
        assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 1), (7, 2)}
        assert got[1, 1] == got[2, 1] == got[7, 2] == 1.0 and 0.5 <= got[3, 1] < 1


def test_score_of_a_hit_is_the_best_alignment_with_the_whole_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    test = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = {r["doc_id"]: words_of(r["text"]) for r in docs.collect()}
    own = {r["item_id"]: words_of(r["text"]) for r in test.collect()}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in contaminated(docs, test).collect()}
    verbatim = {(d, i) for d, t in texts.items() for i, w in own.items() if f" {' '.join(w)} " in f" {' '.join(t)} "}
    assert verbatim and verbatim <= set(got)
    for (d, i), score in list(got.items())[:5]:
        assert score == brute_score(own[i], texts[d]) / (MATCH * len(own[i]))


def test_every_edit_pattern_of_half_a_copy_is_found(spark, documents):
    """Against all alignments: each n-th word replaced, deleted or followed by another, in regular and random places."""
    rnd = random.Random(9)
    common = [f"c{i}" for i in range(12)]
    own = {n: [rnd.choice(common) if rnd.random() < 0.3 else f"i{n}x{k}" for k in range(n)] for n in (3, 4, 5, 8, 13, 30, 31)}
    texts = [" ".join(rnd.choice(common + FILL[:40]) for _ in range(120)) for _ in range(40)]
    for words in own.values():
        marks = [[i % n == n - 1 for i in range(len(words))] for n in (1, 2, 3, 4)]
        marks += [[rnd.random() < p for _ in words] for p in (0.2, 0.35, 0.5) for _ in range(3)]
        for marked in marks:
            for edit in (lambda w: [], lambda w: ["other"], lambda w: [w, "more"], lambda w: rnd.choice([[], ["other"], [w, "more"]])):
                body = [x for w, m in zip(words, marked) for x in (edit(w) if m else [w])]
                texts.append(" ".join(FILL[:60] + body + FILL[60:90]))
    docs = documents([(i, t, "en", "a") for i, t in enumerate(texts)])
    test = spark.createDataFrame([(n, " ".join(w)) for n, w in own.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in contaminated(docs, test).collect()}
    want = {(d, n): brute_score(w, words_of(t)) / (MATCH * n) for d, t in enumerate(texts) for n, w in own.items()}
    assert got == {pair: share for pair, share in want.items() if share >= 0.5} and len(got) > 150


def test_awkward_rows(spark, awkward, nothing):
    assert contaminated(awkward, items(spark)).count() == 0
    assert contaminated(nothing, items(spark)).count() == 0
    assert contaminated(awkward, items(spark).limit(0)).count() == 0
    short = spark.createDataFrame([(1, "one two"), (2, "same row")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in contaminated(awkward, short).collect())
    assert got == [(4, 1), (5, 1), (7, 2), (7, 2)]
