"""Statistics of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonrepair import is_json
from ..functions.scores import to_number
from .columns import col


def column_stats(df: DataFrame, names: list[str]) -> DataFrame:
    """(column, n, mean, least, greatest) of columns read as numbers; one pass over the data for all of them."""
    numbers = df.select(*(to_number(col(n)).alias(f"_{i}") for i, n in enumerate(names)))
    sums = numbers.agg(*(f(f"_{i}").alias(f"_{i}_{k}") for i in range(len(names)) for k, f in (("n", F.count), ("mean", F.avg), ("least", F.min), ("greatest", F.max))))
    one = lambda i, n: F.struct(F.lit(n).alias("column"), F.col(f"_{i}_n").alias("n"), F.round(f"_{i}_mean", 6).alias("mean"), F.col(f"_{i}_least").alias("least"), F.col(f"_{i}_greatest").alias("greatest"))
    return sums.select(F.explode(F.array(*(one(i, n) for i, n in enumerate(names)))).alias("s")).select("s.*")


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """(value, n) of values that are not null, most frequent first."""
    return df.where(col(name).isNotNull()).groupBy(col(name).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def top_values(df: DataFrame, name: str, k: int = 3) -> DataFrame:
    return value_counts(df, name).limit(k)


def date_range(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.min(col(name)).alias("first"), F.max(col(name)).alias("last"))


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


#: Values that a sketch of frequent values tracks, and candidates that it names.
TRACKED, NAMED = 10_000, 64


def one_pass(df: DataFrame, numbers: Sequence[str] = (), tops: Sequence[str] = (), ranges: Sequence[str] = (), k: int = 3) -> dict:
    """rows, stats (as column_stats() by column), tops (as top_values() by column), ranges (first and last by column), in at most two passes over df however many columns.

    The first pass adds up everything and sketches the frequent values; the second counts the candidates of all sketched
    columns. A sketch is off by at most a known share of the rows: where the k-th count doesn't stand clear of what a
    value that was not named may have, and only there, that column is counted as a whole.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(numbers):
        x = to_number(col(n))
        aggregates += [F.count(x).alias(f"n{i}_n"), F.round(F.avg(x), 6).alias(f"n{i}_mean"), F.min(x).alias(f"n{i}_least"), F.max(x).alias(f"n{i}_greatest")]
    for i, n in enumerate(tops):
        aggregates += [F.expr(f"approx_top_k(`{n.replace('`', '``')}`, {NAMED}, {TRACKED})").alias(f"t{i}")]
    for i, n in enumerate(ranges):
        aggregates += [F.min(col(n)).alias(f"r{i}_first"), F.max(col(n)).alias(f"r{i}_last")]
    found = df.agg(*aggregates).head().asDict()
    out: dict = {
        "rows": found["rows"],
        "stats": {n: {key: found[f"n{i}_{key}"] for key in ("n", "mean", "least", "greatest")} for i, n in enumerate(numbers)},
        "tops": {},
        "ranges": {n: (found[f"r{i}_first"], found[f"r{i}_last"]) for i, n in enumerate(ranges)},
    }
    named = {n: [r["item"] for r in found[f"t{i}"] if r["item"] is not None] for i, n in enumerate(tops)}
    counts = [F.count(F.when(col(n) == F.lit(v), 1)).alias(f"{i}_{j}") for i, n in enumerate(tops) for j, v in enumerate(named[n])]
    exact = df.agg(*counts).head().asDict() if counts else {}
    off = 2 * 3.5 * found["rows"] / (TRACKED / 0.75)  # of the sketch, whose table is at least a third larger than what it tracks
    for i, n in enumerate(tops):
        counted = sorted(((exact[f"{i}_{j}"], v) for j, v in enumerate(named[n])), key=lambda x: (-x[0], x[1]))[:k]
        least = min((r["count"] for r in found[f"t{i}"]), default=0) if len(found[f"t{i}"]) == NAMED else 0
        clear = len(counted) == k and counted[-1][0] > least + off
        out["tops"][n] = [(v, c) for c, v in counted] if clear else [(r["value"], r["n"]) for r in top_values(df, n, k).collect()]
    return out


def text_flags(text) -> dict:
    """Diagnostics of a raw text: marks of broken encoding, single-quoted and proper lists."""
    return {"broken_encoding": F.contains(text, F.lit("Ã")), "single_quoted": F.startswith(text, F.lit("[{'")), "double_quoted": F.startswith(text, F.lit('[{"')), "valid_json": is_json(text)}
