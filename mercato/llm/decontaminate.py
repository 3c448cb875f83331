"""Benchmark decontamination: rare word pairs find candidates, Smith-Waterman alignment scores them.

The test items are the small side: a stated set, sent to the tasks in blocks of bounded size, against all documents in
place, so no text is shuffled. A pair is two words with at most one other between them, in the item and in the document.

An alignment with M matches and E edits scores 2 M - E. Between neighbouring matches with no pair lie two edits or more, so
one of share `least` of an item of L words (2 M - E >= 2 least L) has at least M - 1 - E / 2 >= least L - 1 pairs, each with
a first word of its own. Of the L - 1 first words an item may thus miss only some, and one more than these, the rarest
by one count over all documents, are seeds: every such alignment holds one. A second pass finds the seeds in the
documents; where the seed lies in the item tells where the item would start. Where there are as many pairs as an
alignment needs, the words of the item are aligned with the words of the document.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.kept import giving_back

REACH = 2
SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_BYTES = 16 << 20
CELLS = 1 << 21
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; marks and white space are left out, so that edits of them cost nothing."""
    return WORD.findall((text or "").lower())


class Items:
    """A block of test items, as numbers of their own vocabulary."""

    def __init__(self, items: list[tuple[int, str]]):
        self.numbers: dict[str, int] = {}
        self.ids, self.words = [], []
        for item_id, text in items:
            own = [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text)]
            if own:
                self.ids.append(item_id)
                self.words.append(np.array(own, np.int64))
        self.base = len(self.numbers) + 1
        self.reaches = range(0 if any(len(w) == 1 for w in self.words) else 1, REACH + 1)
        #: Per item and first word the keys of its pairs, of a lone word its own.
        firsts = [np.stack([self.keys(w, r) for r in range(1, REACH + 1)])[:, :-1] if len(w) > 1
                  else np.stack([self.keys(w, 0)] * REACH) for w in self.words]
        self.grams = np.unique(np.concatenate([f[f >= 0] for f in firsts])) if firsts else np.empty(0, np.int64)
        #: The same as places in self.grams, len(self.grams) where there is none.
        self.places = [np.where(f >= 0, np.searchsorted(self.grams, f), len(self.grams)) for f in firsts]

    def keys(self, words: np.ndarray, reach: int) -> np.ndarray:
        """Number of the pair of each word and the one `reach` after it (0: the word alone), -1 where one is in no item."""
        out = np.full(len(words), -1, np.int64)
        if reach == 0:
            return np.where(words >= 0, words * self.base + self.base - 1, -1)
        first, second = words[:-reach], words[reach:]
        out[:max(0, len(words) - reach)] = np.where((first >= 0) & (second >= 0), first * self.base + second, -1)
        return out

    def numbered(self, text: str | None) -> np.ndarray:
        words, get = words_of(text), self.numbers.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the document, in order, and in self.grams of the pairs that occur in an item."""
        if not len(self.grams) or not len(words):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = np.stack([self.keys(words, r) for r in self.reaches], axis=1).ravel()
        known = np.flatnonzero(keys >= 0)
        keys = keys[known]
        at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        hit = self.grams[at] == keys
        return known[hit] // len(self.reaches), at[hit]

    def needed(self, item: int, least: float) -> int:
        """First words with a pair that an alignment of share `least` has; one at least."""
        return max(1, math.ceil(least * len(self.words[item]) - 1 - 1e-9))

    def seeds(self, counts: np.ndarray, least: float) -> dict[int, list[tuple[int, int]]]:
        """Pair to the (item, place) of its first words that are seeds: the rarest, one more than may be missed; ties: the first."""
        out, counts = defaultdict(set), np.append(counts, 0)
        for item, places in enumerate(self.places):
            among = places.shape[1]
            for at in np.argsort(counts[places].sum(axis=0), kind="stable")[:max(1, among - self.needed(item, least) + 1)].tolist():
                for gram in places[:, at].tolist():
                    if gram < len(self.grams):
                        out[gram].add((item, at))
        return {gram: sorted(found) for gram, found in out.items()}


def best_scores(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman score of each item with its window, all pairs at once, one row of the matrices after the other.

    A gap in the row is a running maximum once the linear gap cost is added per column.
    """
    tall, wide = max(map(len, items)), max(map(len, windows))
    own = np.full((len(items), tall), -2, np.int64)
    text = np.full((len(items), wide), -1, np.int64)
    for i, (a, b) in enumerate(zip(items, windows)):
        own[i, :len(a)], text[i, :len(b)] = a, b
    ramp = (-GAP * np.arange(wide + 1)).astype(np.int32)
    row, best = np.zeros((len(items), wide + 1), np.int32), np.zeros(len(items), np.int32)
    for i in range(tall):
        step = np.zeros_like(row)
        step[:, 1:] = row[:, :-1] + np.where(text == own[:, i:i + 1], MATCH, MISMATCH)
        step = np.maximum(np.maximum(step, row + GAP), 0)
        row = np.maximum.accumulate(step + ramp, axis=1) - ramp
        best = np.maximum(best, row.max(axis=1))
    return best


def _windows(words: np.ndarray, size: int, starts: list[int], least: float) -> list[tuple[int, int]]:
    """Parts of the document around the places where an item of this size would start; near ones are joined.

    An alignment of share `least` has at most 2 (1 - least) size edits, so it lies within the part of any of its pairs.
    """
    slack = math.ceil(2 * (1 - least) * size) + 2
    spans: list[list[int]] = []
    for start in sorted(set(starts)):
        low, high = max(0, start - slack), min(len(words), start + size + slack)
        if spans and low <= spans[-1][1] and high - spans[-1][0] <= 4 * (size + 2 * slack):
            spans[-1][1] = high
        else:
            spans.append([low, high])
    return [(low, high) for low, high in spans]


def _count_grams(block: Items):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.grams), np.int64)
        for batch in batches:
            for text in batch.column(1):
                total[np.unique(block.found(block.numbered(text.as_py()))[1])] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["gram", "n"])

    return count


def _align(block: Items, seeds: dict[int, list[tuple[int, int]]], least: float):
    wanted = np.zeros(len(block.grams), bool)
    wanted[list(seeds)] = True
    needed = [block.needed(item, least) for item in range(len(block.words))]

    def score(waiting: list) -> list[tuple]:
        """waiting: (row, item, window). Best share of each (row, item) that reaches `least`."""
        waiting.sort(key=lambda x: (len(block.words[x[1]]), len(x[2])))
        best: dict[tuple[int, int], float] = {}
        at = 0
        while at < len(waiting):
            end = at + 1
            while end < len(waiting) and (end - at + 1) * (len(waiting[end][2]) + 1) <= CELLS // 16 and (
                    len(block.words[waiting[end][1]]) <= 2 * len(block.words[waiting[at][1]])):
                end += 1
            part = waiting[at:end]
            scores = best_scores([block.words[x[1]] for x in part], [x[2] for x in part])
            for (row, item, _), value in zip(part, scores.tolist()):
                share = value / (MATCH * len(block.words[item]))
                best[row, item] = max(best.get((row, item), 0.0), share)
            at = end
        return [(row, block.ids[item], share) for (row, item), share in sorted(best.items()) if share >= least]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting, held, out = [], 0, []
            present = np.zeros(len(block.grams) + 1, bool)
            ids = batch.column(0).to_pylist()
            for row, text in enumerate(batch.column(1)):
                words = block.numbered(text.as_py())
                places, grams = block.found(words)
                starts = defaultdict(list)
                keep = wanted[grams]
                for place, gram in zip(places[keep].tolist(), grams[keep].tolist()):
                    for item, inside in seeds[gram]:
                        starts[item].append(place - inside)
                for item, own in starts.items():
                    for low, high in _windows(words, len(block.words[item]), own, least):
                        inside = grams[np.searchsorted(places, low):np.searchsorted(places, high)]
                        present[inside] = True
                        enough = np.count_nonzero(present[block.places[item]].any(axis=0)) >= needed[item]
                        present[inside] = False
                        if enough:
                            waiting.append((row, item, words[low:high]))
                            held += high - low
                if held > CELLS // 4:
                    out, waiting, held = out + score(waiting), [], 0
            out = out + score(waiting)
            columns = list(zip(*[(ids[row], item, share) for row, item, share in out])) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                ["doc_id", "item_id", "score"])

    return run


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of at most `block_bytes` (one item at least), streamed to the driver one by one."""
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter(
            "item_id is not null and text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        if held and size + len(row[1]) > block_bytes:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += len(row[1])
    if held:
        yield held


def contaminated(docs: DataFrame, items: DataFrame, least: float = SCORE, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score: the documents that hold a test item, whole, edited or in parts.

    score is the best local alignment of the item's words with any part of the document as a share of the score of a
    verbatim copy (1.0); pairs of `least` or more are returned, each document row and item once. Clean documents have
    no row. Null or wordless texts and items have none; items without an id are left out; a null document id stays
    null; repeated document rows are judged each. An item of two words is found only by both, with at most one other
    word between them, though one of them alone would score 0.5. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], "doc_id long, item_id long, score double")
    for number, held in enumerate(item_blocks(items, block_bytes)):
        block = Items(held)
        counts = np.zeros(len(block.grams), np.int64)
        counted = texts.mapInArrow(giving_back(_count_grams(block)), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        for row in counted.toLocalIterator():
            counts[row["gram"]] = row["n"]
        own = texts.mapInArrow(giving_back(_align(block, block.seeds(counts, least), least)), "doc_id long, item_id long, score double")
        found = own if number == 0 else found.unionByName(own)
    return found
