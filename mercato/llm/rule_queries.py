"""Quality rules over documents."""

from __future__ import annotations

from mercato.llm.catalog import query
from mercato.llm.robust_rules import judged
from mercato.llm.store import table


@query("op7_robust_rules")
def robust_rules(spark, sf_dir):
    return judged(table(spark, sf_dir, "documents"))
