"""Toxicity and quality of documents."""

from __future__ import annotations

from mercato.llm.catalog import query
from mercato.llm.quality import quality_scores
from mercato.llm.store import table
from mercato.llm.toxicity import toxicity_scores


@query("op4_toxicity")
def toxicity(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality")
def quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
