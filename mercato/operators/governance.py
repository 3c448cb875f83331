"""Who sees which rows and columns, and how long rows are kept."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.instants import day
from mercato.lakehouse import NULL_PARTITION, Lakehouse

# Sensitivity of columns and layer retention in days.
HIGH, MEDIUM, LOW = "high", "medium", "low"
LEVELS = (LOW, MEDIUM, HIGH)
COLUMN_TAGS = {
    "customers": {"email": HIGH, "phone": HIGH, "address": HIGH, "first_name": MEDIUM,
                  "last_name": MEDIUM, "city": MEDIUM, "country": MEDIUM},
    "payments": {"payment_method": HIGH},
    "bronze": {"raw_data": HIGH},
}
RETENTION_DAYS = {"bronze": 730, "silver": 1825}


@dataclass(frozen=True)
class RowPolicy:
    """Members of the groups may see rows the predicate (SQL text) selects."""

    name: str
    groups: tuple[str, ...]
    predicate: str


# The policies on customers.
CUSTOMER_POLICIES = (
    RowPolicy("mexico_only", ("mx-analysts",), "country = 'MX'"),
    RowPolicy("colombia_only", ("co-analysts",), "country = 'CO'"),
    RowPolicy("admin_full_access", ("data-admins",), "true"),
)


def apply_row_policies(df: DataFrame, policies: Iterable[RowPolicy], groups: Iterable[str]) -> DataFrame:
    """Rows any granted policy allows; with policies but no grant, none."""
    policies, mine = list(policies), set(groups)
    if not policies:
        return df
    allowed = F.lit(False)
    for policy in policies:
        if mine & set(policy.groups):
            allowed = allowed | F.expr(policy.predicate)
    return df.where(allowed)


def apply_column_tags(df: DataFrame, tags: Mapping[str, str], clearance: str) -> DataFrame:
    """Columns above the reader's clearance read as NULL."""
    limit = LEVELS.index(clearance)
    return df.select(*[
        F.lit(None).cast(df.schema[c].dataType).alias(c) if LEVELS.index(tags.get(c, LOW)) > limit else F.col(c)
        for c in df.columns])


def secure_view(lake: Lakehouse, name: str, groups: Iterable[str], clearance: str = LOW,
                policies: Mapping[str, Iterable[RowPolicy]] | None = None) -> DataFrame:
    """A Silver table as one reader may see it: rows first, so policies may test hidden columns."""
    rules = {"customers": CUSTOMER_POLICIES} if policies is None else policies
    rows = apply_row_policies(lake.silver(name).read(), rules.get(name, ()), groups)
    return apply_column_tags(rows, COLUMN_TAGS.get(name, {}), clearance)


def expired_rows(df: DataFrame, column: str, keep_days: int, as_of=None) -> DataFrame:
    """Rows older than the retention period, as a range on the stored column."""
    cutoff = F.date_sub(day(as_of), keep_days).cast("timestamp")
    return df.where(F.col(column) < cutoff)


def expired_days(df: DataFrame, column: str, keep_days: int, as_of=None) -> DataFrame:
    return expired_rows(df, column, keep_days, as_of).groupBy(F.to_date(column).alias("day")).agg(
        F.count("*").alias("rows"))


def expire_rows(lake: Lakehouse, layer: str, name: str, column: str, as_of: str) -> None:
    """Rewrite a table without the rows whose ``column`` is past the layer's retention; rows without a time stay."""
    table = (lake.bronze if layer == "bronze" else lake.silver)(name)
    seen = table.state()["parts"]
    cutoff = F.date_sub(day(as_of), RETENTION_DAYS[layer]).cast("timestamp")
    table.replace(table.read().where(F.col(column).isNull() | (F.col(column) >= cutoff)), seen=seen)


def enforce_retention(lake: Lakehouse, layer: str, name: str, as_of: str) -> list[str]:
    """Drop whole days past the layer's retention; returns the days.

    A table that is not kept by day has no days to drop: it is refused, not passed over in silence.
    """
    table = (lake.bronze if layer == "bronze" else lake.silver)(name)
    if not table.partition:
        raise ValueError(f"{layer}.{name} is not kept by day; remove its rows with expire_rows")
    cutoff = str(date.fromisoformat(as_of) - timedelta(days=RETENTION_DAYS[layer]))
    gone = [d for d in table.days() if d != NULL_PARTITION and d < cutoff]
    if gone:
        table.drop_parts(gone)
    return gone
