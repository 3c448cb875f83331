"""Bronze parsing and keyed merge into Silver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.casts import cast_text
from mercato.functions.instants import instant
from mercato.functions.json_fields import parse_object, scalar
from mercato.lakehouse import NULL_PARTITION, Lakehouse, Table
from mercato.schemas import ENTITIES, EntitySpec
from mercato.session import scratch_path

LINEAGE = ("ingested_at", "source")


class DuplicateKeys(RuntimeError):
    """One batch holds a key twice and the caller asked for an error."""


def parse_bronze(bronze: DataFrame, spec: EntitySpec, now: Column | datetime | str | None = None,
                 strict: bool = False, lineage: bool = False) -> DataFrame:
    """Typed Silver columns from raw JSON rows; bad values become NULL unless ``strict``."""
    fields = [f for _, f, _ in spec.fields]
    parsed = parse_object(bronze, spec.json_column, fields, "_doc")
    kept = [F.col(c) for c in spec.carried]
    if lineage:
        kept += [F.col(c).alias(f"_{c}") for c in LINEAGE]
    texts = parsed.select(*kept, *[scalar("_doc", field).alias(name) for name, field, _ in spec.fields])
    return texts.select(
        *spec.carried,
        *[cast_text(F.col(name), kind, strict).alias(name) for name, _, kind in spec.fields],
        instant(now).alias("processed_at"),
        *([f"_{c}" for c in LINEAGE] if lineage else []))


def _all_present(keys: Sequence[str]) -> Column:
    out = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        out = out & F.col(key).isNotNull()
    return out


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose required columns are all set, the rejected rest)."""
    ok = _all_present(required)
    return df.where(ok), df.where(~ok)


def require(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise at run time on a row that lacks a required column."""
    for name in required:
        checked = F.when(F.col(name).isNull(), F.raise_error(F.lit(f"{name} is required")).cast("string"))
        df = df.withColumn(name, F.coalesce(checked.cast(df.schema[name].dataType), F.col(name)))
    return df


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the newest.

    The rank filter runs before the shuffle as well, so a key with most of the
    rows leaves each task as a single row.
    """
    ranked = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def one_per_key(df: DataFrame, spec: EntitySpec, on_duplicate: str = "latest") -> DataFrame:
    """Settle repeated keys of a batch that carries its lineage columns.

    The latest by arrival time wins, then by source, then by the values themselves,
    so the outcome does not depend on row order.
    """
    lineage = [f"_{c}" for c in LINEAGE]
    if on_duplicate == "latest":
        values = [c for c in spec.columns if c not in spec.keys]
        newest = [F.col(c).desc_nulls_last() for c in (*lineage, *values)]
        df = latest_per_key(df, spec.keys, newest)
    elif on_duplicate == "error":
        found = duplicate_keys(df, spec.keys).limit(1).collect()
        if found:
            raise DuplicateKeys(f"{spec.name}: {found[0].asDict()}")
    elif on_duplicate != "all" or not spec.insert_only:
        raise ValueError(f"on_duplicate={on_duplicate!r} does not apply to {spec.name}")
    return df.drop(*lineage)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str],
           small_source: bool = False) -> DataFrame:
    """Target after the merge: matched rows take ``update`` columns, others stay as first inserted.

    Presence of a row decides, not presence of a value: a NULL in the source overwrites.
    One full outer join suits sides of like size. With ``small_source`` updates and
    inserts are two joins, which lets the planner broadcast a source whose measured
    size allows it and leave the target where it is.
    """
    columns = target.columns
    old = target.select(*keys, F.struct(*columns).alias("_old"))
    new = source.select(*keys, F.struct(*columns).alias("_new"))
    if small_source:
        kept = _settled(old.join(new, list(keys), "left"), columns, keys, update)
        return kept.unionByName(insert_absent(target, source.select(*columns), keys))
    return _settled(old.join(new, list(keys), "full_outer"), columns, keys, update)


def _settled(both: DataFrame, columns: Sequence[str], keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Pick each column's value from the old and the new row."""
    fresh = set(update) | {"processed_at"}
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c in fresh:
            out.append(F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col("_old")[c]).alias(c))
        else:
            out.append(F.when(F.col("_old").isNotNull(), F.col("_old")[c]).otherwise(F.col("_new")[c]).alias(c))
    return both.select(*out)


def merged(target: DataFrame, source: DataFrame, spec: EntitySpec) -> DataFrame:
    """The whole table after merging a batch with one row per key."""
    if spec.insert_only:
        return target.unionByName(insert_absent(target, source, spec.keys))
    return upsert(target, source, spec.keys, spec.update)


def batch(bronze: DataFrame, spec: EntitySpec, now=None, on_duplicate: str = "latest",
          strict: bool = False) -> DataFrame:
    """Bronze rows as a merge source: parsed, keyed, settled."""
    parsed = parse_bronze(bronze, spec, now, strict, lineage=True)
    keyed, _ = split_required(parsed, spec.keys)
    return one_per_key(keyed, spec, on_duplicate)


def rejected(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Bronze rows a merge leaves out because a key is missing."""
    return split_required(parse_bronze(bronze, spec, lineage=True), spec.keys)[1]


def merge_into(lake: Lakehouse, name: str, since: datetime | str | None = None, now=None,
               on_duplicate: str = "latest", strict: bool = False,
               protect: Callable[[DataFrame], DataFrame] | None = None, only_new: bool = False) -> None:
    """Merge an entity's Bronze rows into its Silver table.

    ``only_new`` takes the Bronze writes that no merge has taken yet. The Silver commit
    itself remembers up to which Bronze commit it has merged, so nothing is lost or
    taken twice, however late a write is committed. ``since`` takes rows that
    arrived after an instant. ``protect`` is applied to the rows before they are
    stored, e.g. to hide personal columns; off by default.

    Inserts only append. Updates never move a row to another day, so only days
    that hold a matched row are written again. If the table was written meanwhile,
    by another merge say, the merge fails with TableChanged and can be run again.
    """
    spec, table, arrivals = ENTITIES[name], lake.silver(name), lake.bronze(name)
    state, reached = table.state(), arrivals.state()
    seen, merged_up_to = state["parts"], state["txns"].get("bronze", 0)
    if only_new:
        fresh = arrivals.added_after(merged_up_to, reached)
        if not fresh:
            return
        bronze = arrivals.read_write(*fresh)
    else:
        bronze = arrivals.read(first=None if since is None else _utc_day(since))
    if since is not None:
        bronze = bronze.where(F.col("ingested_at") > instant(since))
    source = batch(bronze, spec, now, on_duplicate, strict)
    if protect is not None:
        source = protect(source)
    # Everything of Bronze up to this commit is merged, unless only a part was asked for.
    txn = ("bronze", reached["version"]) if since is None and reached["version"] > merged_up_to else None
    if spec.insert_only:
        table.append(insert_absent(table.read(), source, spec.keys), txn, seen)
        return
    small = only_new or since is not None
    if spec.partition is None:
        table.replace(upsert(table.read(), source, spec.keys, spec.update, small), seen=seen, txn=txn, whole=True)
        return
    # Written once: it is used to find the days, to update and to insert.
    source = staged(source, f"merge-{name}")
    days = _touched_days(table, source.select(*spec.keys), spec)
    table.replace(upsert(table.read(only=days), source, spec.keys, spec.update, small), days, seen, txn, whole=True)


def _utc_day(since: datetime | str) -> str:
    """The UTC day of an instant; text or time without a zone is UTC."""
    at = datetime.fromisoformat(since) if isinstance(since, str) else since
    return str((at if at.tzinfo is None else at.astimezone(timezone.utc)).date())


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to shared storage and read from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _touched_days(table: Table, arriving: DataFrame, spec: EntitySpec) -> list[str]:
    """Days that hold a row about to be updated: at most one entry per calendar day."""
    placed = table.read(keep_partition=True).select(*spec.keys, F.col(spec.partition_column).alias("_day"))
    hit = placed.join(arriving, list(spec.keys), "left_semi").select("_day").distinct()
    return [NULL_PARTITION if r["_day"] is None else str(r["_day"]) for r in hit.collect()]


def not_in(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """``key NOT IN (listed)`` with SQL's rule: one NULL in the list and nothing is kept.

    An anti join plus two counts; the planner's own form would copy the whole
    list to every task.
    """
    values = listed.select(F.col(listed_key).alias("_listed"))
    seen = values.agg(F.count("*").alias("rows"), F.count_if(F.col("_listed").isNull()).alias("nulls"))
    rows, nulls = seen.select("rows").scalar(), seen.select("nulls").scalar()
    once = values.where("_listed is not null").distinct()
    kept = df.join(once, F.col(key) == F.col("_listed"), "left_anti")
    return kept.where((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def insert_if_absent(target: DataFrame, source: DataFrame, spec: EntitySpec,
                     keys: Sequence[str] | None = None) -> DataFrame:
    """Older insert-only load of any entity.

    The older design keyed inventory by product alone, which never adds a second
    warehouse of a known product: pass ``keys=("product_id",)`` to get that.
    """
    return target.unionByName(insert_absent(target, source, keys or spec.keys))
