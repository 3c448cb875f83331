"""Loading files into Bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.instants import instant
from mercato.lakehouse import Lakehouse, Table
from mercato.operators.merge import split_required
from mercato.schemas import ENTITIES
from mercato.sources.csv_files import bronze_from_folder, list_files
from mercato.sources.jdbc import read_jdbc, rows_to_bronze


def append_bronze(table: Table, rows: DataFrame, txn: tuple[str, int] | None = None) -> tuple[str | None, DataFrame]:
    """Append the rows that have their required id; returns the write's id and the rejected rows."""
    ok, rejects = split_required(rows, [table.schema[0].name])
    return table.append(ok, txn), rejects


def csv_to_bronze(lake: Lakehouse, landing: str, entity: str, now=None, ledger: bool = False,
                  multiline: bool = True) -> None:
    """Load an entity's folder. With ``ledger`` files loaded before are skipped."""
    spec = ENTITIES[entity]
    table = lake.bronze(spec.bronze_table)
    if not ledger:
        append_bronze(table, bronze_from_folder(lake.spark, landing, entity, now, multiline=multiline))
        return
    log = lake.bronze("_ingestion_log")
    known = log.read().select("source").distinct()
    fresh = list_files(lake.spark, landing, entity).join(known, "source", "left_anti")
    files = fresh.collect()  # names only, one row per new file
    if not files:
        return
    rows = bronze_from_folder(lake.spark, landing, entity, now, [f["path"] for f in files], multiline=multiline)
    write_id, _ = append_bronze(table, rows)
    listed = lake.spark.createDataFrame(
        [(f["source"], f["file_size"], f["file_mtime"]) for f in files],
        "source string, file_size long, file_mtime timestamp")
    counts = table.read_write(write_id).groupBy("source").agg(F.count("*").alias("rows"))
    log.append(listed.join(counts, "source", "left").withColumn("ingested_at", instant(now)))


def jdbc_to_bronze(lake: Lakehouse, entity: str, url: str, now=None, **how) -> None:
    """Copy a database table's rows into Bronze as JSON text."""
    rows = rows_to_bronze(read_jdbc(lake.spark, url, **how), entity, f"jdbc/{entity}", now)
    append_bronze(lake.bronze(ENTITIES[entity].bronze_table), rows)


def reprocess_range(rows: DataFrame, first: str, last: str, column: str = "ingested_at") -> DataFrame:
    """Rows ingested on the days first..last, both included, as a range the scan can use."""
    upto = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp")
    return rows.where((F.col(column) >= F.lit(first).cast("timestamp")) & (F.col(column) < upto))


def recent_rows(rows: DataFrame, span: str, column: str = "ingested_at", now=None) -> DataFrame:
    """Rows after ``span`` ("15 minutes") before ``now``, that instant left out, as a range the scan can use."""
    return rows.where(F.col(column) > instant(now) - F.expr(f"interval {span}"))


def rows_from(rows: DataFrame, source: str, column: str = "source") -> DataFrame:
    """Rows that one file, stream or table brought."""
    return rows.where(F.col(column) == source)
