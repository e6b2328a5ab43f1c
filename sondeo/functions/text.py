"""URLs, free text and placeholders of missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a missing value reads as text.
MISSING = "nan"
# Fixed value: characters that free text keeps are letters, digits, underscores, white space and . , ! ? : ; -
NOT_KEPT = r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}.,!?:;\-]"
# Texts that a table load reads as missing.
NA_TOKENS = ("", "nan", "NaN", "None", "NA", "N/A", "null", "NULL")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _absent(text: Column) -> Column:
    return text.isNull() | text.isin("", MISSING)


def clean_url(url: Column) -> Column:
    """Stripped and cut at the first question mark; missing gives the empty text."""
    return F.when(_absent(url), "").otherwise(F.substring_index(strip(url), "?", 1))


def clean_feedback(text: Column) -> Column:
    """Stripped, then without other characters than those kept; missing gives the empty text."""
    return F.when(_absent(text), "").otherwise(F.regexp_replace(strip(text), NOT_KEPT, ""))


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)
