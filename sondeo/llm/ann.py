"""Approximate nearest neighbours by inner product: score-aware four-bit product quantisation and exact reranking."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import attach_by_key, bounded_sample, materialize, salt, smallest_of_group

#: Rows that the codebooks are fitted to, at most.
FIT_ROWS = 16_384
#: Components per subspace; each has 16 centres.
WIDTH = 2
#: Inner products from this share of the vectors' norms on are those that matter; it sets the weight of parallel errors.
THRESHOLD = 0.2
#: Of BLOCK_ROWS vectors, those that are scored exactly for each query.
RERANK, BLOCK_ROWS = 256, 8_192
#: Bytes of queries that go to all tasks at a time.
QUERY_BYTES = 8 << 20


def parallel_weight(dims: int, threshold: float = THRESHOLD) -> float:
    """How much a residual along the vector costs against one across it, for queries in all directions."""
    return max(1.0, (dims - 1) * threshold**2 / (1 - threshold**2))


@dataclass
class Codebooks:
    """centres: (subspaces, 16, WIDTH). Vectors are padded with zeros to a multiple of 2 * WIDTH components."""

    dims: int
    centres: np.ndarray

    def _split(self, x: np.ndarray) -> np.ndarray:
        m, _, w = self.centres.shape
        out = np.zeros((len(x), m * w), np.float32)
        out[:, : self.dims] = x
        return out.reshape(len(x), m, w)

    def encode(self, x: np.ndarray, rounds: int = 2) -> np.ndarray:
        """Codes (rows, subspaces): the nearest centres, then by subspace the centre with the least weighted residual, given the others."""
        parts, centres, extra = self._split(x), self.centres, parallel_weight(self.dims) - 1
        norm = np.maximum(np.square(parts).sum(axis=(1, 2)), 1e-30)
        codes = np.empty(parts.shape[:2], np.uint8)
        along = np.empty(parts.shape[:2], np.float32)  # of each subspace's residual, times the vector's norm
        for m in range(parts.shape[1]):
            own = parts[:, m]
            codes[:, m] = np.argmin(np.square(centres[m]).sum(axis=1) - 2 * own @ centres[m].T, axis=1)
            along[:, m] = ((own - centres[m][codes[:, m]]) * own).sum(axis=1)
        total = along.sum(axis=1)
        for _ in range(rounds):
            for m in range(parts.shape[1]):
                own = parts[:, m]
                dots = own @ centres[m].T
                square = np.square(own).sum(axis=1)[:, None]
                across = square - 2 * dots + np.square(centres[m]).sum(axis=1)
                with_it = (total - along[:, m])[:, None] + square - dots
                codes[:, m] = np.argmin(across + extra * np.square(with_it) / norm[:, None], axis=1)
                along[:, m] = square[:, 0] - dots[np.arange(len(own)), codes[:, m]]
                total = with_it[np.arange(len(own)), codes[:, m]]
        return codes

    @classmethod
    def fit(cls, x: np.ndarray, rounds: int = 8, seed: int = 7) -> Codebooks:
        dims = x.shape[1]
        m = 2 * -(-dims // (2 * WIDTH))
        rng = np.random.default_rng(seed)
        out = cls(dims, np.zeros((m, 16, WIDTH), np.float32))
        parts = out._split(x)
        out.centres = np.stack([parts[rng.choice(len(x), 16, replace=len(x) < 16), j] for j in range(m)])
        extra, norm = parallel_weight(dims) - 1, np.maximum(np.square(parts).sum(axis=(1, 2)), 1e-30)
        for _ in range(rounds):
            codes = out.encode(x, 1)
            decoded = out.centres[np.arange(m), codes]
            along = ((parts - decoded) * parts).sum(axis=2)
            total = along.sum(axis=1)
            for j in range(m):
                own, others = parts[:, j], total - along[:, j]
                w = extra / norm
                left = np.eye(WIDTH) + w[:, None, None] * own[:, :, None] * own[:, None, :]
                right = own + (w * (others + np.square(own).sum(axis=1)))[:, None] * own
                for c in range(16):
                    of = codes[:, j] == c
                    if of.any():
                        out.centres[j, c] = np.linalg.solve(left[of].sum(axis=0), right[of].sum(axis=0))
        return out

    def packed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two codes a byte (rows, subspaces / 2), and for each row the factor that undoes the residual along it."""
        codes = self.encode(x)
        parts = self._split(x)
        decoded = self.centres[np.arange(parts.shape[1]), codes]
        square, kept = np.maximum(np.square(parts).sum(axis=(1, 2)), 1e-30), (parts * decoded).sum(axis=(1, 2))
        factor = np.where(kept > 0.1 * square, square / np.where(kept > 0.1 * square, kept, 1), 1)
        return np.ascontiguousarray(codes[:, ::2] | codes[:, 1::2] << 4), factor.astype(np.float32)

    def tables(self, query: np.ndarray) -> np.ndarray:
        """Of a query, for each byte of codes its part of the inner product: (subspaces / 2, 256)."""
        by_code = np.einsum("mcw,mw->mc", self.centres, self._split(query[None])[0])
        return (by_code[::2, None, :] + by_code[1::2, :, None]).reshape(-1, 256).astype(np.float32)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec, v) of rows with an id whose vector is not null or zero and has no null or non-finite component."""
    rows = rows.select(F.col(id_col).cast("long").alias("vec"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))


def with_digest(rows: DataFrame) -> DataFrame:
    """rows (vec, v) with same: a digest that equal vectors share, whatever the sign of their zeros."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("v")
            edges = column.offsets.to_numpy() - column.offsets[0].as_py() if len(b) else []
            flat = column.flatten().to_numpy(zero_copy_only=False) + 0.0
            same = [hashlib.blake2b(flat[i:j].tobytes(), digest_size=16).digest() for i, j in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("vec"), column, pa.array(same, pa.binary())], ["vec", "v", "same"])

    return rows.select("vec", "v").mapInArrow(add, "vec long, v array<double>, same binary")


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in single precision and norms in double. Components are scaled first, so that no square overflows or vanishes."""
    largest = np.abs(x).max(axis=1, keepdims=True)
    scaled = x / largest
    norm = np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))
    with np.errstate(over="ignore"):
        return (scaled / norm).astype(np.float32), (norm * largest)[:, 0]


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; one that overflows is infinite, or last if it has no sign."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = (vectors * query).sum(axis=1)
    return np.where(np.isnan(score), -np.inf, score)


def fitted(rows: DataFrame, dims: int) -> Codebooks:
    """Codebooks of the directions of at most FIT_ROWS rows, picked by a hash of the id; made in a task."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.asarray(b.column("vec")), _vectors(b.column("v"), dims)) for b in batches if len(b)]
        order = np.argsort(np.concatenate([i for i, _ in found]), kind="stable")
        books = Codebooks.fit(directions(np.concatenate([x for _, x in found])[order])[0])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(books.centres)])], ["made"])

    return Codebooks(dims, pickle.loads(bounded_sample(rows, "vec", FIT_ROWS).select("vec", "v").repartition(1).mapInArrow(fit, "made binary").head()[0]))


def indexed(rows: DataFrame, books: Codebooks) -> DataFrame:
    """rows (class, vec, v) with codes, factor and norm. Every row is coded where it is read: no shuffle."""
    dims = books.dims

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit, norm = directions(_vectors(b.column("v"), dims)) if len(b) else (np.zeros((0, dims), np.float32), np.zeros(0))
            codes, factor = books.packed(unit)
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("vec"), b.column("v"), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(factor), pa.array(norm)], ["class", "vec", "v", "codes", "factor", "norm"])

    return rows.select("class", "vec", "v").mapInArrow(code, "class long, vec long, v array<double>, codes binary, factor float, norm double")


def _scan(tables: np.ndarray, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, extent: np.ndarray, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k nearest of a block: a scan of the codes picks `rerank` vectors, which are scored exactly."""
    near = tables[0][codes[0]]
    for j in range(1, len(codes)):
        near += tables[j][codes[j]]
    with np.errstate(over="ignore", invalid="ignore"):
        near = near * extent
    top = np.argpartition(-near, rerank)[:rerank] if rerank < len(near) else np.arange(len(near))
    score = exact(vectors[top], query)
    order = np.lexsort((ids[top], -score))[:k]
    return top[order], score[order]


def scanned(index: DataFrame, books: Codebooks, q_classes: np.ndarray, queries: np.ndarray, k: int, rerank: int) -> DataFrame:
    """(asked, near, vec, score): of each task's part of the index the k vectors nearest to each query.

    A task goes over its rows in blocks and keeps k for each query, so what it holds and sends follows the number of
    queries, which the caller bounds, and not the rows.
    """
    dims = books.dims

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_class, best_id, best = np.zeros((len(q_classes), 0), np.int64), np.zeros((len(q_classes), 0), np.int64), np.zeros((len(q_classes), 0))
        tables = None
        held: list[pa.RecordBatch] = []

        def block() -> None:
            nonlocal best, best_class, best_id, tables
            if tables is None:
                tables = [books.tables(q) for q in directions(queries)[0]]
            table = pa.Table.from_batches(held).combine_chunks()
            classes, ids, vectors = table["class"].to_numpy(), table["vec"].to_numpy(), _vectors(table["v"].combine_chunks(), dims)
            codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.uint8).reshape(len(ids), -1).T.copy()
            with np.errstate(over="ignore"):
                extent = table["norm"].to_numpy() * table["factor"].to_numpy()
            n = min(k, len(ids))
            at, new = np.zeros((len(q_classes), n), np.int64), np.zeros((len(q_classes), n))
            for i, (t, q) in enumerate(zip(tables, queries, strict=True)):
                at[i], new[i] = _scan(t, q, ids, vectors, codes, extent, n, rerank)
            best_class, best_id, best = (np.concatenate(x, axis=1) for x in ((best_class, classes[at]), (best_id, ids[at]), (best, new)))
            order = np.lexsort((best_id, -best), axis=1)[:, :k]
            best_class, best_id, best = (np.take_along_axis(x, order, 1) for x in (best_class, best_id, best))
            held.clear()

        for b in batches:
            for a in range(0, len(b), BLOCK_ROWS):
                held.append(b.slice(a, BLOCK_ROWS))
                if sum(map(len, held)) >= BLOCK_ROWS:
                    block()
        if held:
            block()
        n = best.shape[1]
        for a in range(0, len(q_classes) if n else 0, 1024):
            columns = [np.repeat(q_classes[a : a + 1024], n), *(x[a : a + 1024].ravel() for x in (best_class, best_id, best))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["asked", "near", "vec", "score"])

    return index.mapInArrow(scan, "asked long, near long, vec long, score double")


def _first(rows: DataFrame, key: str, order: list, k: int) -> DataFrame:
    """The first k rows of each key; in each partition no more than k of a key go on to the shuffle."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_n", n).where(F.col("_n") <= k).drop("_n")


def nearest(rows: DataFrame, every: int, k: int, id_col: str = "vec_id", vector_col: str = "embedding", rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, the k other rows with the largest inner products found.

    Equal vectors are one class, which its smallest id stands for: each is coded, scanned and asked once, and its members
    are put in at the end. Codebooks are fitted to the directions of at most FIT_ROWS classes, picked by a hash of the id;
    every class is indexed, by four-bit codes of its direction and its norm. Queries go to the tasks in chunks of about
    QUERY_BYTES, one job each; a task scans the codes of its own part of the index, scores RERANK of each BLOCK_ROWS
    exactly in double precision, and sends k + 1 for each query. So the index is not shuffled, and no pairs of blocks are
    made. Nearest first, ties to the smaller id. Components up to the largest double are fine; an inner product beyond is
    infinite. Vectors null, zero, with null or non-finite components or (of the fewer) another length take no part;
    neither do rows without an id. A row that repeats an id and its vector counts once; different vectors of one id are found as rows of their own. An
    empty table gives no rows.
    """
    good = materialize(with_digest(usable(rows, id_col, vector_col)), "vectors")
    shape = [(r["d"], r["n"]) for r in good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()]
    if not shape:
        return good.select(F.col("vec").alias("query_id"), F.lit(1).alias("rank"), F.col("vec").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    dims = shape[0][0]
    good = good.where(F.size("v") == dims)
    grouped = materialize(smallest_of_group(good.select("vec", "same").distinct(), ["same"], "vec").select("vec", "same", "keep_id"), "same")
    # numbered, as a repeated id may be the smallest of several classes; the written numbers stay
    classes = good.join(grouped.where("vec = keep_id").select("vec", "same"), ["vec", "same"]).dropDuplicates(["same"])
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("class"), "vec", "v", "same"), "classes")
    by_class = materialize(attach_by_key(grouped.select("vec", "same"), ["same"], classes.select("same", "class"), ["vec"]).select("vec", "class"), "members")
    books = fitted(classes, dims)
    index = materialize(indexed(classes, books), "index")

    asked = by_class.where(F.col("vec") % every == 0)
    wanted = materialize(classes.join(asked.select("class").distinct(), "class", "left_semi"), "queries")
    chunks = max(1, -(-wanted.count() * dims * 8 // QUERY_BYTES))
    parts = []
    for c in range(chunks):
        chunk = wanted.where(salt("class", F.lit("chunk"), salts=chunks) == c).toArrow()
        if len(chunk):
            found = scanned(index, books, chunk["class"].to_numpy(), _vectors(chunk["v"].combine_chunks(), dims), k + 1, rerank)
            parts.append(materialize(_first(found, "asked", [F.desc("score"), "vec"], k + 1), "found"))
    if not parts:
        return by_class.select(F.col("vec").alias("query_id"), F.lit(1).alias("rank"), F.col("vec").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    lists = found.groupBy("asked").agg(F.collect_list(F.struct("near", "score")).alias("_near")).withColumnRenamed("asked", "class")
    pairs = attach_by_key(asked.select("vec", "class"), ["class"], lists, ["vec"]).select(F.col("vec").alias("query_id"), F.explode("_near").alias("c")).select("query_id", F.col("c.near").alias("class"), F.col("c.score").alias("score"))
    few = _first(_first(by_class.withColumn("_part", F.xxhash64("class", salt("vec"))), "_part", ["vec"], k + 1), "class", ["vec"], k + 1)
    members = few.groupBy("class").agg(F.collect_list("vec").alias("_ids"))
    pairs = attach_by_key(pairs, ["class"], members, ["query_id"]).select("query_id", F.explode("_ids").alias("vec_id"), "score").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
