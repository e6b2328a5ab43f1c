"""Timestamps without zone from text, and month keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.columns import col as column

_TIMES = (" H:mm:ss", " H:mm", "")
#: For each separator, the formats in which the month comes first, and those in which the day does; of the two, `usual` is taken where a column doesn't tell.
ORDERS = {sep: {"month": tuple(f"M{sep}d{sep}yyyy{t}" for t in _TIMES), "day": tuple(f"d{sep}M{sep}yyyy{t}" for t in _TIMES), "usual": usual} for sep, usual in (("/", "month"), ("-", "day"))}
#: Tried in this order after ISO 8601.
FORMATS = tuple(f for order in ORDERS.values() for f in order[order["usual"]])


def _read(text: Column, pattern: str) -> Column:
    """A timestamp, or null. Only texts with as many colons as the pattern, and with its separator, are tried, as a text that fails costs more than one that is read."""
    separator = next((ch for ch in pattern if not ch.isalpha()), "")
    colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))
    return F.when(F.contains(text, F.lit(separator)) & (colons == pattern.count(":")), F.try_to_timestamp(text, F.lit(pattern)))


def _reads(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*(_read(text, f) for f in formats)).isNotNull()


def order_counts(text: Column, name: str) -> list[Column]:
    """Aggregates: how many texts of a column each order of day and month reads, by separator."""
    return [F.count(F.when(F.rlike(text, F.lit(rf"^\d{{1,2}}{sep}")) & _reads(text, order[first]), 1)).alias(f"{name}{sep}{first}") for sep, order in ORDERS.items() for first in ("month", "day")]


def formats_from(counts: Mapping[str, int], name: str) -> tuple[str, ...]:
    """The formats of a column by its order_counts(): for each separator those of the order that reads more texts, of the usual one where both read as many."""
    out: tuple[str, ...] = ()
    for sep, order in ORDERS.items():
        other = "day" if order["usual"] == "month" else "month"
        more = counts[f"{name}{sep}{other}"] > counts[f"{name}{sep}{order['usual']}"]
        out += order[other if more else order["usual"]]
    return out


def column_formats(df: DataFrame, names: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """For each text column the formats that read it, all of it in one order of day and month. One aggregate for all columns; none if no column is text."""
    own = [n for n in names if n in df.columns and isinstance(df.schema[n].dataType, StringType)]
    if not own:
        return {}
    counts = df.agg(*(c for i, n in enumerate(own) for c in order_counts(column(n), f"{i}"))).head().asDict()
    return {n: formats_from(counts, f"{i}") for i, n in enumerate(own)}


def to_wall_clock(value: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """timestamp_ntz, or null for what is no date; an offset is dropped and the clock time stays."""
    text = value.cast("string")
    return F.coalesce(text.try_cast("timestamp_ntz"), *(_read(text, f).cast("timestamp_ntz") for f in formats))


def month_year(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM")
