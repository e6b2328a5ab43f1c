"""Strict JSON test and repair of single-quoted pseudo-JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT = {"allowSingleQuotes": "false"}
EMPTY = "[]"
#: How text begins whose first key stands in single quotes.
SINGLE_QUOTED = r"^[\s\[]*\{\s*'"


def is_json(text: Column) -> Column:
    """True for one valid JSON value: as the only item of a list it parses strictly. Null is not JSON.

    Text whose first object begins with a single quote never is, so it is not parsed: failing costs more than parsing.
    """
    parsed = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT)) == 1
    return F.when(F.rlike(text, F.lit(SINGLE_QUOTED)), False).otherwise(F.coalesce(parsed, F.lit(False)))


# What a repair replaces, after backslashes are gone. Quotes round a key, and round a value behind a colon.
KEY, KEY_REPAIRED = r"(?U)'(\w+)':", '"$1":'
VALUE, VALUE_REPAIRED = r"(?U):\s*'([^']*?)'", ': "$1"'


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use reads it: as the argument of a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def requoted(text: Column) -> Column:
    """Without backslashes, with double quotes around word keys and around values right after a colon."""
    keys = F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("")), KEY, KEY_REPAIRED)
    return F.regexp_replace(keys, VALUE, VALUE_REPAIRED)


def repair(text: Column) -> Column:
    """struct<text, outcome>: valid text as it is, else its repair if that is valid, else an empty list; outcome is valid, fixed or corrupted. Both null for null."""
    made = lambda x, outcome: F.struct(x.alias("text"), F.lit(outcome).alias("outcome"))
    mended = lambda t: let(requoted(t), lambda r: F.when(is_json(r), made(r, "fixed")).otherwise(made(F.lit(EMPTY), "corrupted")))
    null = F.lit(None).cast("string")
    return let(text, lambda t: F.when(t.isNull(), F.struct(null.alias("text"), null.alias("outcome"))).when(is_json(t), made(t, "valid")).otherwise(mended(t)))


def fix_json(text: Column) -> Column:
    """Valid text as it is, else its repair if that is valid, else an empty list; null stays null."""
    return repair(text)["text"]


def json_outcome(text: Column) -> Column:
    """valid, fixed or corrupted; null for null."""
    return repair(text)["outcome"]


def swap_quotes(text: Column) -> Column:
    """The reduced variant: every single quote becomes a double one."""
    return F.replace(text, F.lit("'"), F.lit('"'))
