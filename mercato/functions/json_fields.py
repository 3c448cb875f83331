"""Scalar fields out of JSON text, one parse per row.

The text is wrapped as one field of an object, with an end mark as the next field.
Arrays, bare scalars, trailing text and two objects on one line are then plain type
or syntax errors, and a brace too many closes the wrapper before the end mark is
read. A syntax error inside a wanted field would only lose that field; the column
for corrupt records tells. So: a document is one JSON object exactly if both fields
come out and nothing was corrupt.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "__bad"}


def _object(text: Column, fields: Iterable[str], kind: str) -> Column:
    shape = ", ".join(f"`{f}`: {kind}" for f in fields)
    wrapped = F.concat(F.lit('{"__doc":'), text, F.lit(',"__end":1}'))
    return F.from_json(wrapped, f"__doc struct<{shape}>, __end int, __bad string", _OPTIONS)


def parse_object(df: DataFrame, json_column: str, fields: Iterable[str], into: str,
                 look_closer: Column | None = None) -> DataFrame:
    """Add ``into``, the fields' texts; NULL where the document is not one JSON object.

    Texts do not tell a nested value from a string, or 0 from "0". For the rows
    where that can matter (``look_closer``; default: those with a bracket inside)
    ``into`` + "_kind" holds the fields as typed values, else it is NULL. A
    generator holds the parse so that later filters cannot copy it below.
    """
    fields = list(fields)
    text = F.col(json_column)
    if look_closer is None:
        inner = F.substring(F.ltrim(text), 2, 2_147_483_647)
        look_closer = F.contains(inner, F.lit("{")) | F.contains(inner, F.lit("["))
    both = F.struct(_object(text, fields, "string").alias("text"),
                    F.when(look_closer, _object(text, fields, "variant")["__doc"]).alias("kind"))
    part = F.col("_parsed.text")
    one_object = part["__end"].isNotNull() & part["__bad"].isNull()
    return df.select("*", F.explode(F.array(both)).alias("_parsed")).select(
        *df.columns, F.when(one_object, part["__doc"]).alias(into), F.col("_parsed.kind").alias(f"{into}_kind"))


def scalar(parsed: str, field: str) -> Column:
    """Text of a scalar field; NULL if absent, JSON null, an object or an array."""
    text, kinds = F.col(parsed)[field], F.col(f"{parsed}_kind")
    nested = F.schema_of_variant(kinds[field]).rlike("^(OBJECT|ARRAY)")
    return F.when(kinds.isNull() | ~nested, text)


# Texts that a value counting as false may have.
_MAYBE_FALSY = r'"\s*:\s*(-?0|false|\[|\{)'


def maybe_falsy(text: Column) -> Column:
    """Whether the document has any value that could count as false without being empty."""
    return text.rlike(_MAYBE_FALSY)


def truthy(parsed: str, field: str) -> Column:
    """False for missing, null, "", 0, false, [] and {}; the strings "0" and "false" are true.

    Needs a parse that looked closer at the ``maybe_falsy`` documents.
    """
    text, kinds = F.col(parsed)[field], F.col(f"{parsed}_kind")
    kind = F.schema_of_variant(kinds[field])
    empty = text.rlike(r"^(-?0(\.0*)?([eE][+-]?\d+)?|false|\[\s*\]|\{\s*\})$")
    return (
        F.when(text.isNull() | (text == ""), F.lit(False))
        .when(kinds.isNull() | ~empty, F.lit(True))
        .otherwise(F.coalesce(kind == "STRING", F.lit(False)))
    )
