"""Whether a loaded table holds what was to be loaded, and which rows it doesn't."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col, text_columns

#: Groups, at most, whose rows are fetched by a list of values; of more, all rows are.
MOST_GROUPS = 500


def measures(df: DataFrame, numbers: Sequence[str]) -> list[tuple[str, str, str]]:
    """(name, function, column) of what is added up by group: rows, values and sums of numbers, values and lengths of texts."""
    texts = text_columns(df)
    out = [("rows", "count", "")]
    for i, n in enumerate(df.columns):
        out.append((f"held_{i}", "count", n))
        if n in numbers:
            out.append((f"sum_{i}", "sum", n))
        elif n in texts:
            out.append((f"length_{i}", "length", n))
    return out


def sums_of(df: DataFrame, groups: Sequence[str], measured: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The measures of a frame by group; sums of doubles are rounded, as their order is not fixed."""
    of = {"count": lambda n: F.count(col(n) if n else F.lit(1)), "sum": lambda n: F.round(F.sum(col(n)), 4), "length": lambda n: F.sum(F.length(col(n)))}
    return df.groupBy(*(col(g) for g in groups)).agg(*(of[f](n).alias(name) for name, f, n in measured))


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names))


def in_groups(groups: Sequence[str], values: Sequence[Sequence]) -> Column:
    """Whether a row is in one of the groups, each a value per column."""
    one = lambda own: reduce(and_, (col(g).isNull() if v is None else col(g) == F.lit(v) for g, v in zip(groups, own, strict=True)))
    return reduce(or_, map(one, values), F.lit(False))


def differing_groups(source: DataFrame, target, table: str, groups: Sequence[str], numbers: Sequence[str] = ("nps_score",)) -> DataFrame:
    """Groups whose measures differ, with source_rows and table_rows (null where a side has no such group).

    The target adds up its own side (target.sums()), a database in the database: one row a group comes back.
    """
    own = [n for n in numbers if n in source.columns]
    measured = measures(source, own)
    a, b = sums_of(source, groups, measured).alias("a"), target.sums(table, groups, measured).alias("b")
    both = a.join(b, _same("a", "b", groups), "full")
    differs = reduce(or_, (~F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}").cast(a.schema[name].dataType)) for name, _, _ in measured))
    return both.where(differs).select(*(F.coalesce(F.col(f"a.`{g}`"), F.col(f"b.`{g}`")).alias(g) for g in groups), F.col("a.rows").alias("source_rows"), F.col("b.rows").cast("long").alias("table_rows"))


def differing_rows(source: DataFrame, target, table: str, groups: Sequence[str], numbers: Sequence[str] = ("nps_score",)) -> DataFrame:
    """Rows of differing groups that only one side has: the source's columns and `only_in` (source or table), as often as they are there more.

    Groups that agree are not fetched. A change that leaves the number of rows and values, all sums and all lengths of
    texts as they are is not seen; compare with exceptAll() where that matters.
    """
    found = differing_groups(source, target, table, groups, numbers).select(*(col(g) for g in groups)).limit(MOST_GROUPS + 1).collect()
    few = len(found) <= MOST_GROUPS
    ours = source.where(in_groups(groups, found)) if few else source
    there = target.members(table, groups, found) if few else target.read(table)
    there = there.select(*(col(n).cast(source.schema[n].dataType).alias(n) for n in source.columns))
    lost, added = ours.exceptAll(there).withColumn("only_in", F.lit("source")), there.exceptAll(ours).withColumn("only_in", F.lit("table"))
    return lost.union(added)
