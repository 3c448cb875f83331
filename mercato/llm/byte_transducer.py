"""Counts of a text by one table-driven pass over its UTF-8 bytes, and the distinct words by a verified hash table.

The transducer has two states, between words and inside one. A byte's class alone decides the next state, so the states of
a whole block of texts are one table look-up, and what each step puts out (a word begins, a code point, a capital, a symbol)
is a second one by state and class. The spans found are hashed by prefix sums and inserted into an open-addressing table,
all words of a block at a time; a slot counts as the same word only if text, length and every byte agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK, UPPER, SYMBOL, REST, OTHER = range(5)
BETWEEN, INSIDE = 0, 1
#: What a step puts out, as bits.
BEGINS, POINT, CAPITAL, SIGN = 1, 2, 4, 8
COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]
#: Texts are taken together up to this many bytes, a longer one alone.
BLOCK_BYTES = 1 << 20
SYMBOLS = "#$%&*|"
#: Words over this many bytes are compared as slices, others eight bytes at a time.
LONG = 64
SCATTER = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier near 2^64 / golden ratio


def byte_classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[0x80:0xC0] = REST
    out[ord("A"):ord("Z") + 1] = UPPER
    out[[ord(c) for c in SYMBOLS]] = SYMBOL
    out[[0x20, *range(0x09, 0x0E)]] = BLANK
    return out


CLASSES = byte_classes()
NEXT = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)  # by class, from either state
OUT = np.array([[POINT, BEGINS | POINT | CAPITAL, BEGINS | POINT | SIGN, BEGINS, BEGINS | POINT],
                [POINT, POINT | CAPITAL, POINT | SIGN, 0, POINT]], np.uint8)  # by state and class


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            base = 0xD1342543DE82EF95  # fixed value: an odd multiplier
            steps = [base, pow(base, -1, 1 << 64)]
            made = [np.full(count, s, np.uint64) for s in steps]
            for m in made:
                m[0] = 1
                np.cumprod(m, out=m)
            self.up, self.down = made
        return self.up[:count], self.down[:count]


def _same(data: np.ndarray, eights: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of `size` bytes at a and at b hold the same bytes."""
    same = np.ones(len(a), bool)
    for i in np.flatnonzero(size > LONG):
        same[i] = np.array_equal(data[a[i]:a[i] + size[i]], data[b[i]:b[i] + size[i]])
    left, done = np.flatnonzero(size <= LONG), 0
    while len(left):
        short = np.minimum(8, size[left] - done).astype(np.uint64)
        over = (np.uint64(8) - short) * np.uint64(8)
        same[left] &= ((eights[a[left] + done] ^ eights[b[left] + done]) << over) == 0
        done += 8
        left = left[same[left] & (size[left] > done)]
    return same


def distinct_words(data: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray, texts: int, powers: Powers) -> np.ndarray:
    """Distinct words of each text: spans at `begin` of `size` bytes, `owner` the text of each. data has eight spare bytes."""
    if not len(begin):
        return np.zeros(texts, np.int64)
    length = len(data) - 8
    up, down = powers.of(length)
    sums = np.zeros(length + 1, np.uint64)
    np.cumsum((data[:length].astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = (sums[begin + size] - sums[begin]) * down[begin] + owner.astype(np.uint64) * SCATTER
    bits = max(4, (2 * len(begin) - 1).bit_length())
    hashes = (hashes ^ (hashes >> np.uint64(29))) * SCATTER
    slots = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    eights = np.ndarray(shape=(length + 1,), dtype="<u8", buffer=data, strides=(1,))
    table, found = np.full(1 << bits, -1, np.int64), np.zeros(texts, np.int64)
    waiting = np.arange(len(begin))
    while len(waiting):
        at = slots[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        there = table[at]
        own = there == waiting
        found += np.bincount(owner[waiting[own]], minlength=texts)
        same = ~own & (owner[there] == owner[waiting]) & (size[there] == size[waiting])
        near = np.flatnonzero(same)
        same[near] = _same(data, eights, begin[there[near]], begin[waiting[near]], size[waiting[near]])
        waiting = waiting[~own & ~same]
        slots[waiting] = (slots[waiting] + 1) & ((1 << bits) - 1)
    return found


def counts(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> np.ndarray:
    """COUNTS, a row per text; text i is data[offsets[i]:offsets[i + 1]], the first offset 0."""
    texts, length = len(offsets) - 1, int(offsets[-1])
    if not length:
        return np.zeros((texts, len(COUNTS)), np.int64)
    classes = CLASSES[data]
    after = NEXT[classes]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[offsets[:-1][offsets[:-1] < length]] = BETWEEN
    out = OUT[before, classes]

    def per_text(bit: int) -> np.ndarray:
        sums = np.zeros(length + 1, np.int64)
        np.cumsum((out & bit) != 0, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    begin = np.flatnonzero(out & BEGINS)
    ends = np.zeros(length, bool)
    ends[:-1] = (after[:-1] == INSIDE) & (before[1:] != after[1:]) & (after[1:] == BETWEEN)
    last = offsets[1:][(offsets[1:] > offsets[:-1])] - 1
    ends[last] = after[last] == INSIDE
    size = np.flatnonzero(ends) + 1 - begin
    owner = np.searchsorted(offsets, begin, side="right") - 1
    spare = np.zeros(length + 8, np.uint8)
    spare[:length] = data
    distinct = distinct_words(spare, begin, size, owner, texts, powers)
    return np.stack([per_text(BEGINS), distinct, per_text(CAPITAL), per_text(POINT), per_text(SIGN)], axis=1)


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK_BYTES."""
    first = 0
    while first < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        end = max(end, first + 1)
        yield first, end
        first = end


def counted(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and COUNTS of every row; a null text counts as empty. Words: runs of anything but blank, tab to return."""
    own = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text_"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(0).cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            held = texts.buffers()[2]
            data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
            made = np.concatenate([
                counts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], powers) for a, b in _blocks(offsets)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *[pa.array(made[:, i]) for i in range(len(COUNTS))]], [*keep, *COUNTS])

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text_"] + [f"{c} long" for c in COUNTS])
    return own.mapInArrow(run, kinds)
