"""Casts from text that give NULL on bad input, and their raising twins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own casts take shorter dates ('2026') and Java suffixes ('1d'); these do not pass.
_DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
_DECIMAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def safe_timestamp(text: Column) -> Column:
    """ISO date-time text to an instant; zone-less text is UTC."""
    return F.when(text.rlike(_DATED), text.try_cast("timestamp"))


def safe_double(text: Column) -> Column:
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def safe_long(text: Column) -> Column:
    """Whole numbers only: '12.5' is NULL."""
    return text.try_cast("bigint")


def safe_bool(text: Column) -> Column:
    """Only true and false in any case; Spark would also take yes, 1, t."""
    low = F.lower(F.trim(text))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


_SAFE = {"timestamp": safe_timestamp, "double": safe_double, "long": safe_long, "boolean": safe_bool}


def cast_text(text: Column, kind: str, strict: bool = False) -> Column:
    """Cast by declared type; ``strict`` raises on text that does not convert."""
    if kind == "string":
        return text
    value = _SAFE[kind](text)
    if not strict:
        return value
    complaint = F.concat(F.lit(f"not a {kind}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(complaint).cast(kind)).otherwise(value)


def money(amount: Column) -> Column:
    """Exact form of a float amount, so that sums do not depend on row order.

    Six decimals and amounts below 1e22, far above any total of the shop; what is no amount (NaN, infinite, larger)
    counts as missing, in sums and in the divisors of means alike.
    """
    return F.when(F.abs(amount) < 1e22, F.nanvl(amount, F.lit(None).cast("double")).try_cast("decimal(28,6)"))


def money_sum(amount: Column) -> Column:
    return F.sum(money(amount))
