"""Toxicity: a linear classifier that counterfactual examples keep from judging by identity terms.

Features of a text are its words and the beginnings of its words, hashed, by the logarithm of their counts, scaled to unit
length. In every labelled text that mentions an identity term each such term is also swapped for another one of its
group; next to the logistic loss the square of the change in the linear score is penalised, so that terms that say who
is spoken of, not how, carry no weight of their own. Neutral mentions are then not taken for toxic ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.labelled import held_out, sample

BITS = 18
PREFIXES = (4, 5, 6, 7)
MOST_LABELLED = 8_000
PASSES = 12
RATE, RIDGE, LASSO, SCALE = 0.3, 1e-4, 2e-4, 10.0
FAIRNESS = 1.0
KEPT = 1 << 19
WORD = re.compile(r"[^\W\d_]+")

# Identity terms by group; a term is swapped for the next one of its group.
IDENTITIES = (
    "women men girls boys",
    "woman man girl boy",
    "christians muslims jews hindus buddhists atheists",
    "christian muslim jewish hindu buddhist atheist",
    "gay lesbian straight bisexual transgender queer",
    "black white asian latino arab",
    "immigrants natives refugees foreigners",
    "deaf blind disabled elderly young",
    "frauen männer mädchen jungen",
    "christen muslime juden hindus",
    "femmes hommes filles garçons",
    "chrétiens musulmans juifs hindous",
    "mujeres hombres chicas chicos",
    "cristianos musulmanes judíos hindúes",
)


def swaps(groups=IDENTITIES) -> dict[str, str]:
    out: dict[str, str] = {}
    for group in groups:
        terms = group.split()
        for term, other in zip(terms, terms[1:] + terms[:1]):
            out.setdefault(term, other)
    return out


class Features(dict):
    """Word to the hashed numbers of itself and its beginnings."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= KEPT:
            self.clear()
        names = [word, *[f"{word[:n]}-" for n in PREFIXES if len(word) > n]]
        made = np.array([zlib.crc32(n.encode("utf-8", "replace")) & ((1 << BITS) - 1) for n in names], np.int64)
        self[word] = made
        return made

    def of(self, words: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and values of the features of a text with these words."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        each = [self[w] for w in words]
        often = np.repeat(np.fromiter(words.values(), np.float64, len(words)), [len(e) for e in each])
        ids, place = np.unique(np.concatenate(each), return_inverse=True)
        values = np.log1p(np.bincount(place, often))
        return ids.astype(np.int32), (values * (SCALE / np.sqrt((values ** 2).sum()))).astype(np.float32)


def text_words(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def swapped(words: Counter, pairs: dict[str, str]) -> Counter | None:
    if not any(w in pairs for w in words):
        return None
    out: Counter = Counter()
    for word, n in words.items():
        out[pairs.get(word, word)] += n
    return out


def _featurised(pairs: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            columns = [[], [], [], []]
            for text in batch.column(2):
                words = text_words(text.as_py())
                other = swapped(words, pairs)
                own = [*features.of(words), *(features.of(other) if other else (None, None))]
                for column, values in zip(columns, own):
                    column.append(None if values is None else values.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.binary()) for c in columns]],
                                             ["doc_id", "label", "ids", "vals", "other_ids", "other_vals"])

    return run


def fit(rows: list, passes: int = PASSES, fairness: float = FAIRNESS) -> tuple[np.ndarray, float]:
    """Weights and intercept by adaptive gradient steps over (label, ids, values, swapped ids, swapped values)."""
    labels = np.array([r[0] for r in rows], np.float64)
    share = min(max(labels.sum() / (len(labels) + 1), 1e-6), 1 - 1e-6)
    weights, seen, base = np.zeros(1 << BITS), np.zeros(1 << BITS), float(np.log(share / (1 - share)))
    order = np.random.default_rng(0)

    def step(ids, gradient):
        seen[ids] += gradient * gradient
        moved = weights[ids] - RATE * gradient / np.sqrt(seen[ids] + 1)
        weights[ids] = np.sign(moved) * np.maximum(0, np.abs(moved) - LASSO)

    for _ in range(passes if len(np.unique(labels)) > 1 else 0):
        for k in order.permutation(len(rows)):
            label, ids, values, other_ids, other_values = rows[k]
            margin = min(max(base + weights[ids] @ values, -30.0), 30.0)
            error = 1 / (1 + np.exp(-margin)) - label
            step(ids, error * values + RIDGE * weights[ids])
            base -= 0.01 * error
            if other_ids is not None:
                both, place = np.unique(np.concatenate([ids, other_ids]), return_inverse=True)
                change = np.bincount(place, np.concatenate([values, -other_values]))
                kept = change != 0
                step(both[kept], 2 * fairness * (weights[both[kept]] @ change[kept]) * change[kept])
    return weights, base


def fitted(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, groups=IDENTITIES) -> tuple[np.ndarray, float]:
    """Fitted on at most `most` labelled documents outside the held-out fold; docs (doc_id, text)."""
    own = docs.join(sample(labels, "toxic", most), "doc_id").select("doc_id", "label", "text")
    made = own.mapInArrow(_featurised(swaps(groups)),
                          "doc_id long, label int, ids binary, vals binary, other_ids binary, other_vals binary")
    rows = []
    for r in sorted(made.collect(), key=lambda r: (r["doc_id"], r["ids"])):
        parts = [None if r[c] is None else np.frombuffer(r[c], kind) for c, kind in (
            ("ids", np.int32), ("vals", np.float32), ("other_ids", np.int32), ("other_vals", np.float32))]
        rows.append((r["label"], *parts))
    return fit(rows)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    most_labelled: int = MOST_LABELLED, groups=IDENTITIES) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: more toxic), predicted (1 if score >= 0.5) of every row.

    Whole texts are read, twice for those learnt from. Null, empty and wordless texts have no features and score by the
    intercept alone. Rows are scored one by one, repeated ones too. Without labels every score is near 0. Other
    columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    weights, base = fitted(texts, labels, most_labelled, groups)
    weights = weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            margins = []
            for text in batch.column(1):
                ids, values = features.of(text_words(text.as_py()))
                margins.append(base + float(weights[ids] @ values))
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins, np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
