"""String expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def jvm_split(text: Column, separator: str) -> Column:
    """Split on a one-character separator the way ``String.split`` does on the JVM.

    Trailing empty pieces are dropped, leading and inner ones stay; the empty string gives one
    empty piece and a string of separators only gives none.
    """
    if len(separator) != 1:
        raise ValueError("a separator is one character")
    # A regular expression that strips the end would look at every inner run of separators again.
    trimmed = F.rtrim(text, F.lit(separator))
    pieces = F.when(trimmed != "", F.split(trimmed, re.escape(separator))).otherwise(F.array().cast("array<string>"))
    return F.when(text == "", F.array(F.lit(""))).otherwise(pieces)


def lines(text: Column) -> Column:
    """The lines of a text, as an array."""
    return jvm_split(text, "\n")


def is_json_array(text: Column) -> Column:
    """True for JSON text that holds an array; false for any other text and for null."""
    return F.coalesce(F.ltrim(text).startswith("["), F.lit(False))
