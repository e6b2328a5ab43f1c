"""Ranked lexical search by inverted treaps: postings in doc_id search order and impact heap order."""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import salt, small_batches
from .terms import DIGITS, LETTERS, byte_table, words

#: Bytes of query texts that go to the tasks at once. Postings and documents that a task indexes before it is asked.
QUERY_BYTES, SHARD_POSTINGS, SHARD_DOCS = 8 << 20, 1_000_000, 50_000
#: Query cells (queries by their terms) that are asked together; intervals of a query that are split at once; cells of waiting intervals from which on the smallest are taken first.
ASKED_CELLS, SPLIT, WAITING_CELLS = 1 << 14, 16, 1 << 23
#: Stands for an id that is null; smaller than all others.
NO_ID = -(2**63)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n_words: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """What a posting scores for each unit of its term's weight."""
    m = 10 + 90 * n_words * n_docs // n_all
    return 10**9 * tf // (1000 * tf + 8 * m)


class Treaps:
    """One treap per term over the documents of a shard. Node i is the i-th posting by (term, document): in-order is doc_id order, parents have no smaller impact. Equal impacts are ordered by a hash, so that copies don't make a chain."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        order = np.lexsort((doc, term))
        self.term, self.doc, self.impact = term[order], doc[order], impact[order]
        self.width = int(doc.max(initial=0)) + 1
        self.key = self.term * self.width + self.doc
        mixed = self.key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        heap = (self.impact << 32 | mixed.astype(np.int64)).tolist()
        left, right = [-1] * len(heap), [-1] * len(heap)
        self.root = np.full(n_terms, -1, np.int64)
        edges = np.searchsorted(self.term, np.arange(n_terms + 1))
        for t in np.flatnonzero(np.diff(edges)).tolist():
            spine: list[int] = []
            for i in range(int(edges[t]), int(edges[t + 1])):
                last = -1
                while spine and heap[spine[-1]] < heap[i]:
                    last = spine.pop()
                left[i] = last
                if spine:
                    right[spine[-1]] = i
                spine.append(i)
            self.root[t] = spine[0]
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)

    def impact_of(self, nodes: np.ndarray) -> np.ndarray:
        return np.where(nodes >= 0, self.impact[nodes], 0) if len(self.impact) else np.zeros(nodes.shape, np.int64)

    def within(self, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of each subtree (a row's nodes), the highest node whose document is from the row's low to below its high; -1 where there is none.

        Subtrees may reach beyond their interval: what lies outside is passed by.
        """
        out = nodes.copy()
        cells, columns = out.ravel(), nodes.shape[1]
        open_ = np.flatnonzero(cells >= 0)
        while len(open_):
            doc, row = self.doc[cells[open_]], open_ // columns
            on_right, on_left = doc < low[row], doc >= high[row]
            open_, on_left = open_[on_right | on_left], on_left[on_right | on_left]
            cells[open_] = np.where(on_left, self.left[cells[open_]], self.right[cells[open_]])
            open_ = open_[cells[open_] >= 0]
        return out

    def scores(self, terms: np.ndarray, weights: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each row's document, the sum over the row's terms: a search in each treap's in-order."""
        key = terms * self.width + at[:, None]
        found = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[found] == key) & (terms >= 0), weights * self.impact[found], 0).sum(1)


class Best:
    """The k best documents of each query so far: by score, ties by id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.query, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least, self.last = np.ones(n, np.int64), np.full(n, 2**63 - 1, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        query, score, doc = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, query))
        query, score, doc = query[order], score[order], doc[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        kept = (nth < self.k) & (score > 0)
        self.query, self.score, self.doc = query[kept], score[kept], doc[kept]
        full = kept & (nth == self.k - 1)
        self.least[query[full]], self.last[query[full]] = score[full], doc[full]

    def may_enter(self, query: np.ndarray, bound: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a document from id `first` on that scores at most `bound` can be among them."""
        return (bound > self.least[query]) | (bound == self.least[query]) & (first <= self.last[query])


def ask(treaps: Treaps, ids: np.ndarray, query: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Puts the shard's best documents for the queries (a row of terms, padded with -1, and weights each) into best; returns how many were scored.

    What waits are intervals of documents, each with the highest node of every term in it. An interval can score at most
    the sum of these nodes' weighted impacts; where that can't enter the best any more, the interval goes with all its
    subtrees. Of each query the SPLIT most promising intervals are split at the document of their best node, which is
    scored. If very many cells wait, small intervals come first, so that their number stays bounded by the treaps' depth.
    """
    nodes = np.where(terms >= 0, treaps.root[terms], -1)
    asked, low, high = np.arange(len(query)), np.zeros(len(query), np.int64), np.full(len(query), len(ids))
    scored = 0
    while True:
        worth = weights[asked] * treaps.impact_of(nodes)
        bound = worth.sum(1)
        kept = (bound > 0) & best.may_enter(query[asked], bound, ids[np.minimum(low, len(ids) - 1)])
        if not kept.any():
            return scored
        asked, low, high, nodes, worth, bound = (x[kept] for x in (asked, low, high, nodes, worth, bound))
        first = high - low if nodes.size > WAITING_CELLS else -bound
        order = np.lexsort((first, asked))
        nth = np.arange(len(order)) - np.searchsorted(asked[order], asked[order])
        now, later = order[nth < SPLIT], order[nth >= SPLIT]
        top = nodes[now, worth[now].argmax(1)]
        at = treaps.doc[top]
        best.add(query[asked[now]], treaps.scores(terms[asked[now]], weights[asked[now]], at), ids[at])
        scored += len(now)
        before, after = treaps.within(nodes[now], low[now], at), treaps.within(nodes[now], at + 1, high[now])
        asked, nodes = np.concatenate([asked[later], asked[now], asked[now]]), np.concatenate([nodes[later], before, after])
        low, high = np.concatenate([low[later], low[now], at + 1]), np.concatenate([high[later], at, high[now]])


def asked_groups(terms_by_query: list[list[int]], weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Queries in groups of about ASKED_CELLS cells: their numbers, their terms padded with -1, their weights."""
    order = sorted((q for q, t in enumerate(terms_by_query) if t), key=lambda q: -len(terms_by_query[q]))
    while order:
        width = len(terms_by_query[order[0]])
        n = max(1, ASKED_CELLS // width)
        group, order = order[:n], order[n:]
        terms = np.array([terms_by_query[q] + [-1] * (width - len(terms_by_query[q])) for q in group], np.int64)
        yield np.array(group, np.int64), terms, np.where(terms >= 0, weights[terms], 0)


def corpus_counts(docs: DataFrame, index: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents (id, text as bytes) with a term, all their terms, and how many documents have each term of the index. A task sends one row for each term at most."""
    table, n_terms = byte_table(LETTERS + DIGITS), len(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                found = words(text, table)
                held[n_terms] += bool(found)
                held[n_terms + 1] += len(found)
                held.update(index[w] for w in set(found).intersection(index))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], ["term", "n"])

    sums = np.zeros(n_terms + 2, np.int64)
    for term, n in docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        sums[term] = n
    return int(sums[n_terms]), int(sums[n_terms + 1]), sums[:n_terms]


def best_of_parts(docs: DataFrame, index: dict[bytes, int], terms_by_query: list[list[int]], weights: np.ndarray, n_docs: int, n_all: int, k: int) -> DataFrame:
    """query, doc, score: of each task the k best documents of each query. A task indexes its documents shard by shard, and asks each shard with what it found in those before as the bar."""
    table, n_terms = byte_table(LETTERS + DIGITS), len(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(terms_by_query), k)
        groups = list(asked_groups(terms_by_query, weights))
        ids: list[int] = []
        lengths: list[int] = []
        doc_of, term_of, tf_of = array("q"), array("q"), array("q")

        def shard() -> None:
            if ids:
                order = np.argsort(np.array(ids, np.int64), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                doc, term, tf = (np.array(x, np.int64) for x in (doc_of, term_of, tf_of))
                treaps = Treaps(term, place[doc], impacts(tf, np.array(lengths, np.int64)[doc], n_docs, n_all), n_terms)
                for group in groups:
                    ask(treaps, np.array(ids, np.int64)[order], *group, best)
            for held in (ids, lengths, doc_of, term_of, tf_of):
                del held[:]

        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = words(text, table)
                hits = Counter(index[w] for w in found if w in index)
                if hits:
                    doc_of.extend([len(ids)] * len(hits))
                    term_of.extend(hits.keys())
                    tf_of.extend(hits.values())
                    ids.append(NO_ID if key is None else key)
                    lengths.append(len(found))
                    if len(doc_of) >= SHARD_POSTINGS or len(ids) >= SHARD_DOCS:
                        shard()
        shard()
        found = pa.array(best.doc, mask=best.doc == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(best.query), found, pa.array(best.score)], ["query", "doc", "score"])

    return docs.mapInArrow(search, "query long, doc long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """item, rank, id, score: for each item the k documents with the highest scores above 0, ties by the smaller id.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A term weighs weight(); a
    document scores the sum over the item's terms, once each, of weight times impacts(). Weights are of doubles, all else
    is of 64-bit integers.

    Two scans of docs for each QUERY_BYTES of queries: one counts, one indexes the documents where they are (postings of
    the queries' terms only) and searches. Nothing but k documents a query and task is shuffled.

    Null and empty texts have no terms. Rows that share an item are one query of all their terms; items without a
    document found have no rows. Every row of docs is a document, also one that repeats an id; ids are integers; a null id
    is found as null and comes first among equals. No rows where either table is empty. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    texts = queries.select(F.col(item_col).alias("item"), F.coalesce(query_col, F.lit("")).cast("binary").alias("text"))
    item_type = queries.schema[item_col].dataType
    chunks = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // QUERY_BYTES))
    table = byte_table(LETTERS + DIGITS)
    out = spark.createDataFrame([], f"{item_col} {item_type.simpleString()}, rank int, {id_col} long, score long")
    for c in range(chunks):
        by_item: dict = {}
        for item, text in texts.where(salt("item", F.lit("chunk"), salts=chunks) == c).collect():
            by_item.setdefault(item, set()).update(words(bytes(text), table))
        index = {w: i for i, w in enumerate(sorted(set().union(*by_item.values())))}
        if not index:
            continue
        n_docs, n_all, df = corpus_counts(base, index)
        weights = np.array([weight(n_docs, int(n)) if n else 0 for n in df], np.int64)
        items = list(by_item)
        asked = [[i for i in sorted(index[w] for w in by_item[x]) if weights[i]] for x in items]
        found = best_of_parts(base, index, asked, weights, n_docs, n_all, k)
        order = [F.desc("score"), "doc"]
        part = found.withColumn("_part", salt("doc", "score", salts=64))
        few = part.withColumn("_n", F.row_number().over(Window.partitionBy("query", "_part").orderBy(*order))).where(F.col("_n") <= k)
        ranked = few.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("_n") <= k)
        named = spark.createDataFrame(list(enumerate(items)), f"query long, item {item_type.simpleString()}")
        rows = ranked.join(F.broadcast(named), "query").select(F.col("item").alias(item_col), F.col("_n").alias("rank"), F.col("doc").alias(id_col), "score")
        out = rows if c == 0 else out.unionByName(rows)
    return out
