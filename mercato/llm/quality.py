"""Quality classifier: boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.boosted_trees import Trees, fit
from mercato.llm.kept import giving_back
from mercato.llm.labelled import held_out, sample
from mercato.llm.store import saved
from mercato.llm.text_stats import shape, shaped

LEAST_SCORE = 0.3
MOST_LABELLED = 20_000


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fitted(stats: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Trees:
    """Trees fitted on at most `most` labelled documents outside the held-out fold; only their numbers reach the driver."""
    rows = stats.join(sample(labels, "quality", most), "doc_id").orderBy("doc_id", "stats").select("stats", "label").collect()
    return fit(np.array([r["stats"] for r in rows], np.float64), np.array([r["label"] for r in rows], np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   most_labelled: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better), predicted (1 if score >= 0.3) of every row.

    Every whole text is read once; its statistics are written and used both to learn and to score. Null and empty
    texts have the statistics of an empty text. Rows are scored one by one, repeated ones too. Without labels every
    score is near 1, so nothing is rejected. Other columns are ignored.
    """
    stats = saved(shaped(docs, id_col, text_col), "stats")
    trees = fitted(stats, labels, most_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(_matrix(batch.column(1))))], ["doc_id", "score"])

    return stats.mapInArrow(giving_back(run), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   most_labelled: int = MOST_LABELLED) -> DataFrame:
    """The rows of docs, all columns, whose text scores 0.3 or more. No row is moved: each task drops its own."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    learnt = texts.join(saved(sample(labels, "quality", most_labelled), "sample").select("doc_id"), "doc_id", "left_semi")
    trees = fitted(shaped(learnt), labels, most_labelled)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([shape(t.as_py()) for t in batch.column(place)], np.float64)
            yield batch.filter(pa.array(trees.score(stats) >= LEAST_SCORE if len(stats) else np.zeros(0, bool)))

    return docs.mapInArrow(giving_back(run), docs.schema)
