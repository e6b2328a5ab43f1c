"""Audit of how far the sources of a language are from each other and from the language, by exact sums over their words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, small_batches
from .terms import LETTERS, byte_table, words

#: Documents of a language that a kept term is in, at least; what is added to each count; parts of a whole that prices are told in; terms shown by group.
LEAST_DOCS, PRIOR, SCALE_STEPS, SHOWN = 30, 5, 3, 50
#: Entries that a task counts before it sends them on; pair sums that a task holds before it sends them on; cells of one step.
HELD, HELD_PAIRS, CELLS = 400_000, 1_000_000, 2_000_000


def price(count: str, total: str, kept: str) -> Column:
    """1 + floor(10**9 * (count + PRIOR) / (total + PRIOR * kept)), null without kept terms.

    By long division in steps of 1,000, so that no 64-bit product overflows while total + PRIOR * kept is under 9 * 10**15.
    """
    divisor = f"({total} + {PRIOR} * {kept})"
    quotient, left = "0L", f"({count} + {PRIOR}L)"
    for _ in range(SCALE_STEPS):
        quotient, left = f"({quotient} * 1000 + ({left} * 1000) div {divisor})", f"(({left} * 1000) % {divisor})"
    return F.expr(f"case when {kept} > 0 then 1 + {quotient} end")


def group_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: of each group's documents (lang, source, text as bytes) the occurrences of a term and the documents with it; several rows of a key, to be added up, from tasks that each hold at most HELD entries."""
    small_batches(docs.sparkSession)
    table = byte_table(LETTERS)

    def sums(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), own in ((k, v) for k, v in held.items() if v):
            found = np.array(list(own.values()), np.int64).reshape(-1, 2)
            rows = [pa.array([lang] * len(own)), pa.array([source] * len(own)), pa.array(list(own), pa.binary()), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(rows, ["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, list[int]]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = held.setdefault((lang, source), {})
                entries -= len(own)
                for term, n in Counter(words(text, table)).items():
                    if entry := own.get(term):
                        entry[0] += n
                        entry[1] += 1
                    else:
                        own[term] = [n, 1]
                entries += len(own)
                if entries > HELD:
                    yield from sums(held)
                    held, entries = {}, 0
        yield from sums(held)

    found = docs.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return found.withColumn("term", F.col("term").cast("string"))


def kept_postings(counts: DataFrame, least: int) -> DataFrame:
    """lang, term, source, n, n_lang, first: terms that at least `least` documents of the language have, with the language's occurrences; first marks one row of each (lang, term). A key has a row per source and task at most."""
    own = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term")
    rows = own.withColumns({"n_lang": F.sum("n").over(by_term), "_docs": F.sum("docs").over(by_term), "first": F.row_number().over(by_term.orderBy("source")) == 1})
    return rows.where(F.col("_docs") >= least).select("lang", "term", "source", "n", "n_lang", "first")


def _one_sided(ns: np.ndarray, terms: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each of the others, the sum over terms of |price - other|: prices ns in ascending order, each that of so many terms."""
    below = np.concatenate([[0], np.cumsum(terms)])
    worth = np.concatenate([[0], np.cumsum(terms * ns)])
    at = np.searchsorted(ns, others)
    return others * (2 * below[at] - below[-1]) + worth[-1] - 2 * worth[at]


def support_sums(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """lang, a, b (numbers of groups, a < b), value: what all terms add when each counts as if the two groups had none in common.

    A group's histogram (how many of its terms have which price) gives the terms that one side has, against the other's
    price of nothing; the terms that neither has come as a constant. One row per group goes to Python: its histogram and
    the prices of nothing in its language.
    """
    bars = postings.groupBy("lang", "at", "p").agg(F.count(F.lit(1)).alias("terms")).groupBy("lang", "at").agg(F.sort_array(F.collect_list(F.struct("p", "terms"))).alias("bars"))
    sides = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "zero", "terms"))).alias("sides"))
    rows = groups.join(bars, ["lang", "at"], "left").join(sides, "lang").where("kept > 0")
    none = F.array().cast("array<bigint>")
    rows = rows.select("lang", "at", "zero", "terms", "kept", F.coalesce("bars.p", none).alias("p"), F.coalesce("bars.terms", none).alias("n"), F.col("sides.at").alias("ats"), F.col("sides.zero").alias("zeros"), F.col("sides.terms").alias("others"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ats, zeros, others = (np.array(r[c], np.int64) for c in ("ats", "zeros", "others"))
                value = _one_sided(np.array(r["p"], np.int64), np.array(r["n"], np.int64), zeros)
                # each pair comes twice, once from either group; the constant goes with one of them
                value += np.where(ats > r["at"], (r["kept"] - r["terms"] - others) * np.abs(r["zero"] - zeros), 0)
                far = ats != r["at"]
                a, b = np.minimum(ats, r["at"])[far], np.maximum(ats, r["at"])[far]
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(value[far])], ["lang", "a", "b", "value"])

    return rows.mapInArrow(add_up, "lang string, a long, b long, value long")


def overlap_sums(postings: DataFrame) -> DataFrame:
    """lang, a, b, value: what is to be added to support_sums() for the terms that both groups have; several rows of a pair, to be added up.

    A term's postings meet in one row, at most one entry per source of the language. Tasks add up by pair as they go and
    send sums only, never the pairs of a term.
    """
    lists = postings.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("at", "p", "zero"))).alias("list")).where(F.size("list") > 1)
    rows = lists.select("lang", F.col("list.at").alias("at"), F.col("list.p").alias("p"), F.col("list.zero").alias("zero"))

    def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        a, b, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((b, a))
        a, b, value = a[order], b[order], value[order]
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        return a[starts], b[starts], np.add.reduceat(value, starts)

    def out(lang: str, sums: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(sums[0]), pa.string()), *map(pa.array, sums)], ["lang", "a", "b", "value"])

    def pairs(at: np.ndarray, p: np.ndarray, zero: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Of lists of one length, one to a row, the pairs of entries that stand k apart, for each k."""
        for k in range(1, at.shape[1]):
            pa_, pb, za, zb = p[:, :-k], p[:, k:], zero[:, :-k], zero[:, k:]
            value = np.abs(pa_ - pb) - np.abs(pa_ - zb) - np.abs(za - pb) + np.abs(za - zb)
            yield at[:, :-k].ravel(), at[:, k:].ravel(), value.ravel()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, ...]]] = {}
        cells_held: Counter = Counter()
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            flat = [c.flatten().to_numpy() for c in batch.columns[1:]]
            begins = np.cumsum(sizes) - sizes
            for lang in dict.fromkeys(langs):
                for n in np.unique(sizes[langs == lang]):
                    which = np.flatnonzero((langs == lang) & (sizes == n))
                    step = max(1, CELLS // n)
                    for i in range(0, len(which), step):
                        cells = begins[which[i : i + step], None] + np.arange(n)
                        for made in pairs(*(x[cells] for x in flat)):
                            held.setdefault(lang, []).append(made)
                            cells_held[lang] += len(made[0])
                            if cells_held[lang] > CELLS:
                                sums = summed(held.pop(lang))
                                cells_held[lang] = 0
                                if len(sums[0]) > HELD_PAIRS:
                                    yield out(lang, sums)
                                else:
                                    held[lang] = [sums]
        for lang, own in held.items():
            yield out(lang, summed(own))

    return rows.mapInArrow(add_up, "lang string, a long, b long, value long")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST_DOCS, shown: int = SHOWN) -> DataFrame:
    """lang, source, part, item, value, rank: distances of the sources of each language, and the terms that a source has more of than its language.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps those that at least
    `least` of its documents have. A group (lang, source), and a language, prices each kept term: price(). Part `pair`:
    for each other source of the language the sum of |p - q| over all kept terms, all ranks. Part `term`: kept terms that
    occur in the group and have p > q, q the language's price, by p - q, ranks to `shown`. Largest first, ties by the
    UTF-8 bytes of the item. All sums are of 64-bit integers.

    Pair sums by inclusion and exclusion over supports: as if the groups had no term in common (support_sums), then the
    terms that they do have in common (overlap_sums).

    Null texts, languages and sources are empty ones. A group without terms still has its pairs; a language without kept
    terms has values of 0. Repeated rows are documents of their own. An empty table gives no rows; other columns are not read.
    """
    base = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    postings = materialize(kept_postings(group_counts(base), least), "postings")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    of_group = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    of_lang = postings.groupBy("lang").agg(F.sum("n").alias("total_lang"), F.count(F.when(F.col("first"), 1)).alias("kept"))
    groups = base.select("lang", "source").distinct().withColumn("at", number).join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "total_lang", "kept"]).withColumn("zero", price("0L", "total", "kept"))
    groups = materialize(groups, "groups")

    priced = postings.join(groups.select("lang", "source", "at", "total", "total_lang", "kept", "zero"), ["lang", "source"])
    priced = materialize(priced.withColumns({"p": price("n", "total", "kept"), "q": price("n_lang", "total_lang", "kept")}).select("lang", "source", "at", "term", "p", "q", "zero"), "priced")

    named = groups.select("lang", "source", "at", "kept")
    sums = support_sums(groups, priced).unionByName(overlap_sums(priced)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = sums.select("lang", "value", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("lang", F.col("x.a").alias("at"), F.col("x.b").alias("other"), "value")
    bare = named.where("kept = 0").select("lang", "source", "at")
    bare = bare.alias("a").join(bare.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.at") != F.col("b.at"))).select("a.lang", "a.source", F.col("b.source").alias("item"), F.lit(0).cast("long").alias("value"))
    pairs = ways.join(named.select("lang", "source", "at"), ["lang", "at"]).join(named.select("lang", F.col("source").alias("item"), F.col("at").alias("other")), ["lang", "other"]).select("lang", "source", "item", "value")
    terms = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    pairs = pairs.unionByName(bare).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= shown).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
