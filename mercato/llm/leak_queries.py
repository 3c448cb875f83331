"""Documents that hold benchmark items."""

from __future__ import annotations

from mercato.llm.catalog import query
from mercato.llm.decontaminate import contaminated
from mercato.llm.store import table


@query("op2_decontaminate")
def benchmark_leaks(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
