"""Text and JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

# Everything up to and including the space counts as blank.
BLANKS = "".join(chr(code) for code in range(33))


def strip(col: Column) -> Column:
    """Remove blanks of any kind from both ends."""
    return F.btrim(col, F.lit(BLANKS))


def clean(col: Column) -> Column:
    """Stripped text; a missing value is the empty string."""
    return F.coalesce(strip(col), F.lit(""))


def clean_lower(col: Column) -> Column:
    return F.lower(clean(col))


def json_field(doc: Column, path: str) -> Column:
    """One field of a JSON document as clean text (``path`` like ``$.a.b``)."""
    return clean(F.get_json_object(doc, path))


def json_array(doc: Column, path: str, element: DataType) -> Column:
    """An array inside a JSON document, null when it is missing or empty."""
    parsed = F.from_json(F.get_json_object(doc, path), ArrayType(element))
    return none_if_empty(parsed)


def none_if_empty(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)


def split_json_list(text: Column) -> Column:
    """``["a","b"]`` as an array, by dropping quotes and brackets."""
    return F.split(F.regexp_replace(text, r'["\[\]]', ""), ",")
