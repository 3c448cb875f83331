"""Operational databases over JDBC: read in place, or copy to Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.csv_files import to_bronze


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 split_on: tuple[str, int, int, int] | None = None, **extra: str) -> dict[str, str]:
    """Reader options. ``split_on`` = (column, lowest, highest, parts) reads in parallel."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, **extra}
    if split_on is None:
        options["dbtable" if table else "query"] = table or query
        return options
    column, low, high, parts = split_on
    options["dbtable"] = table or f"({query}) q"
    options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                "numPartitions": str(parts)}
    return options


def read_jdbc(spark: SparkSession, url: str, **how) -> DataFrame:
    """Rows of a remote table; column choice and filters run in the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **how)).load()


def rows_to_bronze(rows: DataFrame, entity: str, source: str, now=None) -> DataFrame:
    """Database rows as Bronze rows, the first column being the record id."""
    return to_bronze(rows, entity, F.lit(source), now)
