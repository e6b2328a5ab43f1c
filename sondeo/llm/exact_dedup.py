"""Exact deduplication by progressive refinement: length, then a hash of the start, then a hash of everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, only_kept, smallest_of_group

#: White space that counts as one space. Fixed value of the contract.
WHITE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 256
#: Bits of a filter per key that it holds, and of a filter at most: 2**26 bits are 1,048,576 rows of a long.
KEY_BITS, FILTER_BITS = 16, 26


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _with_mark(rows: DataFrame, keys: DataFrame, cols: list[str], name: str) -> DataFrame:
    """rows with a boolean: true where cols may be in keys, which they never fail to be told of. keys goes to all tasks as a bitmap of bounded size, however many there are."""
    bits = max(20, min(FILTER_BITS, (KEY_BITS * max(1, keys.count()) - 1).bit_length()))
    at = F.pmod(F.xxhash64(*cols), F.lit(1 << bits))
    word, bit = F.floor(at / 64).cast("int"), F.expr("shiftleft(1L, cast(_at % 64 as int))")
    bitmap = keys.select(word.alias("_word"), at.alias("_at")).select("_word", bit.alias("_bit")).groupBy("_word").agg(F.expr("bit_or(_bit)").alias("_bits"))
    marked = rows.withColumns({"_word": word, "_at": at}).join(F.broadcast(bitmap), "_word", "left")
    return marked.withColumn(name, (F.coalesce("_bits", F.lit(0).cast("long")).bitwiseAND(bit)) != 0).drop("_word", "_at", "_bits")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of docs: id_col, the carried columns, keep_id, group_size, kept.

    Rows are grouped by the length of the normalised text. Of lengths that several rows have, rows are grouped by a hash
    of the first PREFIX_CHARS characters. Only documents of groups that survive this are hashed in full (SHA-256). Each
    step is a scan, to which a bitmap of the groups that survived the step before tells what to look at; a false alarm in
    it costs a hash, not a result. Equal length, prefix hash and SHA-256 make a group; its smallest id stays.

    Null text is the empty text; all empty texts are one group. Rows that repeat an id are all labelled; a group counts
    rows. A null id is never the one that stays unless all ids of its group are null. An empty table gives an empty
    result; other columns of docs are not touched unless carried.
    """
    norm, start = normalised(F.col(text_col)), F.xxhash64(F.substring("_norm", 1, PREFIX_CHARS))
    base = docs.select(F.col(id_col).alias("_id"), *(c.alias(f"_c_{k}") for k, c in (carry or {}).items()), norm.alias("_norm"))
    base = base.withColumn("_len", F.octet_length("_norm"))

    by_length = materialize(base.groupBy("_len").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    by_start = _with_mark(base, by_length.where("_n > 1"), ["_len"], "_again").where("_again")
    by_start = materialize(by_start.groupBy("_len", start.alias("_start")).agg(F.count(F.lit(1)).alias("_n")), "starts")
    seen = _with_mark(base, by_length.where("_n > 1"), ["_len"], "_again").withColumn("_start", F.when(F.col("_again"), start))
    seen = _with_mark(seen, by_start.where("_n > 1"), ["_len", "_start"], "_twice")
    full = F.when(F.col("_again") & F.col("_twice"), F.sha2("_norm", 256))
    rows = materialize(seen.select("_id", *(f"_c_{k}" for k in carry or {}), "_len", "_start", full.alias("_full")), "rows")

    shared = smallest_of_group(rows.where("_full is not null"), ["_len", "_start", "_full"], "_id")
    alone = rows.where("_full is null").select("*", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    out = shared.unionByName(alone)
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_c_{k}").alias(k) for k in carry or {}), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose text an earlier id has; a row that repeats an id and its text stays once, different texts of one id all stay, and so do rows without an id."""
    name = free_name(docs, "_digest")
    digest = F.sha2(normalised(F.col(text_col)), 256)
    kept = exact_groups(docs, id_col, text_col, carry={name: digest}).where("kept").select(id_col, name)
    return only_kept(docs.withColumn(name, digest), kept, id_col, name).select(*docs.columns)
