"""CSV files in a folder per entity, as Bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.instants import instant
from mercato.schemas import ENTITIES, EntitySpec

CORRUPT = "_corrupt"
PATH = "_path"
BLOCK = "_block"


def csv_columns(spec: EntitySpec) -> list[str]:
    """Header an entity's files carry, in order."""
    return list(spec.carried) + [field for _, field, _ in spec.fields]


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])


def csv_options(multiline: bool = True) -> dict[str, str]:
    return {
        "header": "true", "encoding": "UTF-8", "escape": '"', "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "enforceSchema": "false",
        "pathGlobFilter": "*.csv", "recursiveFileLookup": "true", "nullValue": "\u0000",
    }


def _plain_path(uri: Column) -> Column:
    """File path as written: the reader reports it percent-encoded."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _tidy(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty fields are '' (the reader gives NULL); a short row keeps NULL for what it lacks.

    Rows of another length than the header come with their text, whose commas
    outside quotes tell how many fields there were.
    """
    record = F.col(CORRUPT)
    unquoted = F.regexp_replace(record, r'"([^"]|"")*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    values = [F.coalesce(F.col(c), F.when(record.isNull() | (fields > i), F.lit(""))).alias(c)
              for i, c in enumerate(columns)]
    return raw.select(*values, _plain_path(F.col("_metadata.file_path")).alias(PATH),
                      F.col("_metadata.file_block_start").alias(BLOCK))


def read_entity_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None,
                    multiline: bool = True) -> DataFrame:
    """All values as text plus the file's path.

    ``columns`` is the expected header; a file with another one is an error. With
    None the header of the files is used, which must be the same in all of them.
    ``multiline=False`` lets Spark split big files that quote no line breaks.
    """
    options = csv_options(multiline)
    if columns is None:
        plain = {k: v for k, v in options.items() if k != "columnNameOfCorruptRecord"}
        columns = spark.read.options(**plain).csv(path).columns
    raw = spark.read.schema(text_schema(columns)).options(**options).csv(path)
    return _tidy(raw, columns)


def stream_entity_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """New files of a folder as they arrive; each file is taken once, whole."""
    raw = spark.readStream.schema(text_schema(columns)).options(**csv_options()).csv(path)
    return _tidy(raw, columns)


def relative_path(path: Column, root: str) -> Column:
    """Path below the landing folder, e.g. customers/data.csv."""
    folder = root.rstrip("/").split(":", 1)[-1].rstrip("/") + "/"
    return F.substring_index(path, folder, -1)


def route(name: Column) -> Column:
    """Bronze table for an object name; NULL for other folders and non-CSV names."""
    table = F.lit(None).cast("string")
    for entity, spec in ENTITIES.items():
        table = F.when(F.split_part(name, F.lit("/"), F.lit(1)) == entity, spec.bronze_table).otherwise(table)
    return F.when(F.endswith(name, F.lit(".csv")), table)


def route_by_folder(df: DataFrame, name_column: str, into: str = "table_name") -> DataFrame:
    return df.withColumn(into, route(F.col(name_column)))


def number_lines(rows: DataFrame, into: str) -> DataFrame:
    """Row number within each file, without bringing a file's rows to one task.

    A block of a file is read by one task in order, so a row's place in its block is
    its distance from the block's first row; only counts per block are ordered.
    """
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    blocks = placed.groupBy(PATH, BLOCK).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(PATH).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    line = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return placed.join(starts, [PATH, BLOCK]).withColumn(into, line).select(*rows.columns, into)


def to_bronze(rows: DataFrame, entity: str, source: Column, now=None) -> DataFrame:
    """Envelope rows as JSON text: all columns as strings, in order, empty ones kept."""
    columns = [c for c in rows.columns if c not in (PATH, BLOCK)]
    doc = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]),
                    {"ignoreNullFields": "false"})
    stamped = [source.alias("source"), instant(now).alias("ingested_at")]
    if not ENTITIES[entity].carried:
        return rows.select(F.col(columns[0]).cast("string").alias("record_id"), doc.alias("raw_data"), *stamped)
    if "event_id" in columns:
        event_id = F.col("event_id").cast("string")
    else:
        rows = number_lines(rows, "_line")
        event_id = F.concat(F.lit("ev-auto-"), F.col("_line").cast("string"))
    event_type = F.col("event_type").cast("string") if "event_type" in columns else F.lit("unknown")
    return rows.select(event_id.alias("event_id"), event_type.alias("event_type"),
                       doc.alias("raw_payload"), *stamped)


def bronze_from_folder(spark: SparkSession, root: str, entity: str, now=None, files: list[str] | None = None,
                       columns: Sequence[str] | None = None, multiline: bool = True) -> DataFrame:
    """Bronze rows of an entity's folder below ``root`` (or of the named files in it)."""
    where = files if files is not None else f"{root.rstrip('/')}/{entity}"
    rows = read_entity_csv(spark, where, columns or csv_columns(ENTITIES[entity]), multiline)
    source = F.concat(F.lit("gcs/"), relative_path(F.col(PATH), root))
    return to_bronze(rows, entity, source, now)


def list_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """An entity's CSV files with size and time; contents are not read."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/{entity}"))
    path = _plain_path(F.col("path"))
    return found.select(path.alias("path"), F.concat(F.lit("gcs/"), relative_path(path, root)).alias("source"),
                        F.col("length").alias("file_size"), F.col("modificationTime").alias("file_mtime"))


NOTIFICATION = "bucket string, name string, size string, contentType string"


def decode_notifications(messages: DataFrame, data_column: str = "data") -> DataFrame:
    """Base64 JSON upload notices as columns, with the table each file belongs to.

    ``table_name`` is NULL for files that are skipped.
    """
    text = F.unbase64(F.col(data_column)).cast("string")
    notice = F.from_json(text, NOTIFICATION)
    opened = messages.select("*", F.explode_outer(F.array(notice)).alias("_notice"))
    return opened.select(
        *messages.columns,
        F.coalesce(F.col("_notice.bucket"), F.lit("")).alias("bucket"),
        F.coalesce(F.col("_notice.name"), F.lit("")).alias("name"),
        F.col("_notice.size").try_cast("bigint").alias("size"),
        F.col("_notice.contentType").alias("content_type"),
        F.split_part(F.coalesce(F.col("_notice.name"), F.lit("")), F.lit("/"), F.lit(1)).alias("folder"),
        route(F.col("_notice.name")).alias("table_name"),
    )
