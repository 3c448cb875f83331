"""Numbers about a whole text, for rules and classifiers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.kept import giving_back

BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHAPES = ["n_lines", "upper", "digits", "marks", "bangs", "distinct_words", "top_word", "short_words", "long_words",
          "word_spread", "closed_lines", "first_upper"]


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


KINDS = np.array([
    _mask(BLANK), _mask(SYMBOLS), _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("0123456789"), _mask(".,;:?'\"()-"), _mask("!"),
    (np.arange(256) & 0xC0) == 0x80], np.int64)


def repeated(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of `width` words that occur twice or more, first ones included."""
    if len(words) < width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    count, windows = len(words) - width + 1, ids[:len(words) - width + 1]
    for i in range(1, width):
        windows = windows * len(numbers) + ids[i:i + count]
        if i < width - 1:
            windows = np.unique(windows, return_inverse=True)[1]
    _, place, often = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(often[place] > 1)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + width, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def counts(text: str | None) -> tuple[list[int], list[bytes], np.ndarray, list[str]]:
    """COUNTS of a text, its words, its bytes by KINDS, and its lines that hold a word."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    kinds = KINDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    word_chars = len(data) - int(kinds[6]) - int(kinds[0])
    own = [len(words), word_chars, int(kinds[1]), len(lines) - len(set(lines)), repeated(words)]
    return own, words, kinds, lines


def shape(text: str | None) -> list[float]:
    """COUNTS and SHAPES: the latter shares of words, characters or lines, logarithms for sizes."""
    own, words, kinds, lines = counts(text)
    n, chars = max(1, len(words)), max(1, own[1])
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    often = Counter(words)
    closed = sum(x.rstrip(BLANK)[-1] in ".!?:" for x in lines)
    return [np.log1p(own[0]), own[1] / n, own[2] / n, own[3] / max(1, len(lines)), own[4] / n,
            np.log1p(len(lines)), kinds[2] / chars, kinds[3] / chars, kinds[4] / chars, kinds[5] / n, len(often) / n,
            max(often.values(), default=0) / n, float((lengths <= 3).mean()), float((lengths >= 12).mean()),
            float(lengths.std()), closed / max(1, len(lines)), sum(w[:1].isupper() for w in words) / n]


def _table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, COUNTS and, as strings group_0, group_1 ..., the columns `groups` of every row; null text counts as empty."""
    names = [f"group_{i}" for i in range(len(groups))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([counts(t.as_py())[0] for t in batch.column(1)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(rows[:, i]) for i in range(len(COUNTS))],
                                              *batch.columns[2:]], ["doc_id", *COUNTS, *names])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *[F.col(g).cast("string").alias(n) for g, n in zip(groups, names)])
    return own.mapInArrow(giving_back(run), "doc_id long, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{n} string" for n in names]))


def shaped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and shape(text) as array<double> `stats` of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([shape(t.as_py()) for t in batch.column(1)], np.float64)
            width = len(COUNTS) + len(SHAPES)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * width
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))], ["doc_id", "stats"])

    return _table(docs, id_col, text_col).mapInArrow(giving_back(run), "doc_id long, stats array<double>")
