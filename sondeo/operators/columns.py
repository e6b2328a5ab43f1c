"""Choosing, dropping and renaming columns by name, when a plan is built."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scores import to_number


def col(name: str):
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def first_with_all(names: Iterable[str], parts: Iterable[str]) -> str | None:
    parts = tuple(parts)
    return next((n for n in names if all(p in n.lower() for p in parts)), None)


def with_any(names: Iterable[str], parts: Iterable[str]) -> list[str]:
    parts = tuple(parts)
    return [n for n in names if any(p in n.lower() for p in parts)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def keep(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the order wanted."""
    return df.select(*(col(n) for n in dict.fromkeys(wanted) if n in df.columns))


def map_columns(df: DataFrame, names: Iterable[str], change) -> DataFrame:
    return df.withColumns({n: change(col(n)) for n in names})


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Without rows in which every column is null. With a column that never is, no filter: pushed down, it would compute all others twice."""
    return df.dropna("all") if all(f.nullable for f in df.schema.fields) else df


def retype_numbers(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """df with text columns (all, or the named ones) as numbers where every text in them is one: whole numbers as long, others as double.

    As a table read back from text takes its types. One aggregate looks at all columns; a column without any text stays.
    """
    own = [n for n in (text_columns(df) if names is None else names) if n in text_columns(df)]
    if not own:
        return df
    is_whole = lambda n: F.rlike(col(n), F.lit(r"^\s*[+-]?\d{1,18}\s*$"))
    counts = df.agg(*(x.alias(f"{k}{i}") for i, n in enumerate(own) for k, x in (("n", F.count(col(n))), ("number", F.count(to_number(col(n)))), ("whole", F.count(F.when(is_whole(n), 1)))))).head()
    kinds = {n: "long" if counts[f"whole{i}"] == counts[f"n{i}"] else "double" for i, n in enumerate(own) if counts[f"n{i}"] and counts[f"number{i}"] == counts[f"n{i}"]}
    return df.withColumns({n: F.trim(F.regexp_replace(col(n), r"\s", "")).try_cast("long") if k == "long" else to_number(col(n)) for n, k in kinds.items()})
