"""String column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_class(text: Column, char_class: str) -> Column:
    """Remove every character of a regex class such as ``[a-z, !]``."""
    return F.regexp_replace(text, f"(?:{char_class})+", "")


def distinct_chars(text: Column) -> Column:
    """Characters of the text, each once, in first-seen order."""
    return F.array_join(F.array_distinct(F.split(text, "")), "")


def concat_descending(values: Column) -> Column:
    return F.array_join(F.sort_array(values, asc=False).cast("array<string>"), "")


def codes_to_text(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda c: F.chr(c)), "")
