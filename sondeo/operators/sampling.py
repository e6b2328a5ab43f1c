"""Samples of exact size that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col

#: Default size and seed.
SIZE, SEED = 300_000, 42
#: Bits that one histogram looks at: a driver gets 2**BITS counts at most. Hashes that it takes instead, when no more are left.
BITS, FEW = 14, 4_096


def _hash_of_row(df: DataFrame) -> Column:
    """A hash of all columns; equal rows have equal ones."""

    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(F.lit(SEED), *(col(f.name) if hashable(f.dataType) else F.to_json(F.struct(col(f.name))) for f in df.schema.fields))


def smallest_hashes(df: DataFrame, hashed: Column, n: int) -> tuple[int, int] | None:
    """(limit, left): as many rows as n - left have a hash below limit, and at least `left` of those that have it are wanted too; None if df has no more than n rows.

    Histograms of the leading bits, then of the next ones within the part where the n-th smallest lies, each a count with
    map-side sums over one column; once FEW rows are left there, their hashes come to the driver.
    """
    # unsigned, in the order of signed numbers: the sign bit is turned
    rows, fixed = df.select(hashed.bitwiseXOR(F.lit(-(2**63))).alias("_at")), 0
    while True:
        taken = min(64, fixed + BITS)
        part = F.shiftrightunsigned("_at", 64 - taken)
        counts = sorted((r[0] % 2**64, r[1]) for r in rows.groupBy(part).agg(F.count(F.lit(1))).collect())
        if not fixed and sum(c for _, c in counts) <= n:
            return None
        for found, count in counts:
            if n < count:
                break
            n -= count
        if not n or taken == 64:
            return _signed(found << (64 - taken)), n
        fixed, rows = taken, rows.where(part == found)
        if count <= FEW:
            inside = sorted(r[0] % 2**64 for r in rows.collect())
            return _signed(inside[n]), n - sum(x < inside[n] for x in inside)


def _signed(at: int) -> int:
    return at - 2**63


def exact_sample(df: DataFrame, key: str, n: int = SIZE, seed: int = SEED) -> DataFrame:
    """n different rows (all, if there are fewer): those with the smallest seeded hash of the key, however rows are partitioned.

    Two or three jobs over the key find the hash up to which rows are taken; the sample is then a filter, without a
    shuffle, a sort or a task that all of it passes. Where more rows than are wanted share the last hash (a key that
    repeats), the same is done with a hash of the whole row among them, and of rows that are equal altogether as many
    copies are made as are wanted. Null keys are a key like others. n of 0 or less gives no rows.
    """
    if n <= 0:
        return df.limit(0)
    hashed = F.xxhash64(col(key), F.lit(seed))
    found = smallest_hashes(df, hashed, n)
    if found is None:
        return df
    limit, left = found
    below = df.where(hashed < limit)
    if not left:
        return below
    tied, row = df.where(hashed == limit), _hash_of_row(df)
    found = smallest_hashes(tied, row, left)
    if found is None:
        return below.unionByName(tied)
    row_limit, copies = found
    some = tied.where(row < row_limit)
    out = below.unionByName(some)
    if not copies:
        return out
    name = "_copy"
    while name in df.columns:
        name += "_"
    one = tied.where(row == row_limit).limit(1)
    return out.unionByName(one.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop(name))


def sample_name(stem: str, n: int) -> str:
    return f"{stem}_muestra_{n}"


def cleaned_name(stem: str) -> str:
    return f"{stem}_LIMPIO"
