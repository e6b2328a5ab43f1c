"""Repair of text whose UTF-8 was read as Latin-1."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is replaced by what, in this order. The bare U+00C3 takes every one that is left.
RULES = (
    ("Ã³", "ó"),
    ("Ã¡", "á"),
    ("Ã©", "é"),
    ("Ã­", "í"),
    ("Ãº", "ú"),
    ("Ã±", "ñ"),
    ("Ã", "Í"),
    ("Â¿", "¿"),
    ("Â¡", "¡"),
    ("Â", ""),
)
# Fixed values of the reduced variant: no rule for a bare U+00C3.
PLAIN_RULES = tuple(r for r in RULES if r[0] != "Ã")


def fix_encoding(text: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Text with no character that a rule starts with can't be changed by any: it is not searched for each of them."""
    fixed = text
    for wrong, right in rules:
        fixed = F.replace(fixed, F.lit(wrong), F.lit(right))
    starts = sorted({wrong[0] for wrong, _ in rules})
    return F.when(reduce(or_, (F.contains(text, F.lit(s)) for s in starts)), fixed).otherwise(text)


def encoding_hits(text: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """How many rules found something, each counted once; 0 for null."""
    hits = F.lit(0)
    for wrong, right in rules:
        hits = hits + F.when(F.contains(text, F.lit(wrong)), 1).otherwise(0)
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return hits


def redecode(text: Column) -> Column:
    """Extension: true re-decoding, which also repairs capitals that the rules miss."""
    return F.decode(F.encode(text, "ISO-8859-1"), "UTF-8")
