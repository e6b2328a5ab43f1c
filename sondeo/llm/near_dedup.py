"""Near-duplicates by bottom-k sketches: inverted lists, union-sketch estimates, exact Jaccard, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_by_key, free_name, hot_keys, join_by_key, materialize, only_kept, rank_within, semi_join, small_batches, smallest_of_group
from .components import connected_components

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Values that a sketch retains. The bounds below lose a link of larger sets, at a Jaccard of just 0.75, with a chance of
#: under 1e-12 each (miss_chances() computes it), less than that of two shingles with one hash; of sets that are retained whole, none.
RETAINED = 128
#: Of a set that is not retained whole, as many of its smallest values make runs of RUN that have inverted lists.
LISTED, RUN = 112, 3
#: A pair goes on to the exact check if the union sketch says at least this Jaccard.
ESTIMATE = 0.45
#: Signatures: of each of 64 hash bins two bits of its smallest value. Pairs that differ in more bins than this are not looked at.
BINS, DIFFERING = 64, 37
#: Turns in which every list is a star. Lists with more pairs across components left than this are then compared tile by tile.
STARS, DENSE_PAIRS, TILE_ROWS, TILE_SHINGLES = 2, 2_000, 512, 1 << 20
#: Texts that are hashed between two results.
PART_ROWS = 512
#: Bytes of text that are hashed at a time.
PART_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of at most a few MB, and where they start."""
    if not data:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _WHITE[raw], [True]]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)))])
    return mixed((sums[last] - sums[first]) * _powers(_INVERSE, len(raw))[first] + (last - first).astype(np.uint64)), first


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Indexes and texts of about PART_BYTES together; of a longer text, parts cut at white space, each alone."""
    own: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) > PART_BYTES:
            if own:
                yield own, [texts[j] for j in own]
                own, size = [], 0
            at = 0
            while at < len(t):
                end = at + PART_BYTES
                while end < len(t) and not _WHITE[t[end]]:
                    end += 1
                yield [i], [t[at:end]]
                at = end
            continue
        own.append(i)
        size += len(t) + 1
        if size > PART_BYTES:
            yield own, [texts[j] for j in own]
            own, size = [], 0
    if own:
        yield own, [texts[j] for j in own]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Of each whole text the sorted hashes of its distinct shingles: WORDS words, or all of fewer; none without words."""
    data = [t.encode("utf-8", "surrogatepass").lower() if isinstance(t, str) else b"" for t in texts]
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    long: dict[int, list[np.ndarray]] = {}
    for own, parts in _parts(data):
        words, first = _word_hashes(b" ".join(parts))
        if len(own) == 1 and len(data[own[0]]) > PART_BYTES:
            long.setdefault(own[0], []).append(words)
            continue
        bounds = np.searchsorted(first, np.cumsum([0] + [len(p) + 1 for p in parts]))
        shingles = _shingles(words)
        for i, a, b in zip(own, bounds[:-1], bounds[1:], strict=True):
            out[i] = np.unique(shingles[a : b - WORDS + 1]) if b - a >= WORDS else _short(words[a:b])
    for i, pieces in long.items():
        words = np.concatenate(pieces)
        out[i] = np.unique(_shingles(words)) if len(words) >= WORDS else _short(words)
    return out


def _shingles(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - WORDS + 1)
    total = np.zeros(n, np.uint64)
    for k, c in enumerate(_PLACES):
        total += words[k : k + n] * c
    return mixed(total)


def _short(words: np.ndarray) -> np.ndarray:
    return mixed((words * _PLACES[: len(words)]).sum(keepdims=True) + np.uint64(len(words))) if len(words) else words


def _signature(values: np.ndarray) -> tuple[int, int]:
    """Two longs of 32 bins each; a bin without a value has the bits 00."""
    bins, first = np.unique(values & np.uint64(BINS - 1), return_index=True)
    bits = np.zeros(BINS, np.uint64)
    bits[bins.astype(np.int64)] = mixed(values[first]) & np.uint64(3)
    words = (bits.reshape(2, -1) << np.arange(0, BINS, 2, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)
    return int(words[0]), int(words[1])


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, n, same (fingerprint of the whole set), sketch (the RETAINED smallest hashes), s1 and s2 (signature) of every row."""
    kinds = (("n", T.LongType()), ("same", T.BinaryType()), ("sketch", T.BinaryType()), ("s1", T.LongType()), ("s2", T.LongType()))
    schema = T.StructType([T.StructField("doc", docs.schema[id_col].dataType), *(T.StructField(k, t) for k, t in kinds)])

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), PART_ROWS):
                part = pdf.iloc[a : a + PART_ROWS]
                sets = shingle_sets(part["t"].tolist())
                signs = [_signature(s) for s in sets]
                yield pd.DataFrame({"doc": part["d"], "n": [len(s) for s in sets], "same": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "sketch": [s[:RETAINED].tobytes() for s in sets], "s1": [x for x, _ in signs], "s2": [y for _, y in signs]})

    return docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")).mapInPandas(sketch, schema)


def miss_chances(jaccard: float = PERCENT / 100) -> dict[str, float]:
    """Chances that a link of large sets with this Jaccard has no list in common, differs in too many bins, or is estimated too low."""
    runs = [1.0] + [0.0] * (RUN - 1)  # by length of the run of common values that ends here
    for _ in range(LISTED):
        runs = [sum(runs) * (1 - jaccard), *(x * jaccard for x in runs[:-1])]
    at_most = lambda n, p, k: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    same = 1 - 0.75 * (1 - jaccard)
    return {"lists": sum(runs), "signature": at_most(BINS, same, BINS - DIFFERING - 1), "estimate": at_most(RETAINED, jaccard, math.ceil(ESTIMATE * RETAINED) - 1)}


def _keys(n: int, values: np.ndarray) -> np.ndarray:
    """The lists that a document is in: those of runs of neighbouring retained values.

    Two different sets with a Jaccard of 3/4 have a union of U >= 4 values. Between the at most U/4 values that one of them
    lacks there is a run of 2 common ones, and of 3 if U > 8: for sets that are retained whole these lists are sure to meet.
    Of larger sets, runs of RUN among the LISTED smallest values of the union meet but for miss_chances().
    """
    values = values if n <= RETAINED else values[:LISTED]
    runs = [np.zeros(0, np.uint64)]
    for length, low, high in ((2, 3, 11), (RUN, 7, 1 << 62)):
        if low <= n <= high:
            m = len(values) - length + 1
            total = np.full(m, length, np.uint64)
            for k in range(length):
                total = mixed(total + values[k : k + m])
            runs.append(total)
    return np.concatenate(runs)


def inverted_lists(reps: DataFrame, n_reps: int) -> DataFrame:
    """(list, doc): the inverted lists that hold at least two documents; none is too long to be there.

    Keys and documents travel as arrays. A batch sends each of its keys once to the key's part, with a mark if it has the
    key again; those further documents are known to be in a list of two and are dealt by batch. So a key gets to one task
    as often as there are batches that hold it, not documents.
    """
    parts = max(8, n_reps * LISTED // 400_000)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            keys = [_keys(n, np.frombuffer(s, np.uint64)) for n, s in zip(pdf["n"], pdf["sketch"], strict=True)]
            docs = np.repeat(pdf["doc"].to_numpy(np.int64), [len(k) for k in keys])
            key = np.concatenate(keys)
            if not len(key):
                continue
            order = np.lexsort((docs, key))
            key, docs = key[order], docs[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            again = np.append(~new[1:], False)
            kind = np.where(new, np.where(again, ONE_OF_MORE, ALONE), FURTHER)
            part = (mixed(key ^ np.where(new, np.uint64(0), mixed(docs.astype(np.uint64)))) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part * 3 + kind, kind="stable")
            key, docs, part, kind = key[order], docs[order], part[order], kind[order]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(part * 3 + kind)) + 1, [len(key)]])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield pd.DataFrame({"part": [part[a]], "kind": [kind[a]], "keys": [key[a:b].tobytes()], "docs": [docs[a:b].tobytes()]})

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(pdf["keys"]), np.uint64)
        docs = np.frombuffer(b"".join(pdf["docs"]), np.int64)
        kind = np.repeat(pdf["kind"].to_numpy(), [len(k) // 8 for k in pdf["keys"]])
        order = np.argsort(key, kind="stable")
        key, docs, kind = key[order], docs[order], kind[order]
        same = key[1:] == key[:-1]
        met = np.concatenate([[False], same]) | np.append(same, False)
        keep = met | (kind != ALONE)
        return pd.DataFrame({"list": key[keep].view(np.int64), "doc": docs[keep]})

    ALONE, ONE_OF_MORE, FURTHER = 0, 1, 2
    dealt = reps.select("doc", "n", "sketch").mapInPandas(deal, "part long, kind long, keys binary, docs binary")
    return dealt.groupBy("part").applyInPandas(gather, "list long, doc long")


def _alike(x: str, y: str) -> str:
    """SQL: sizes and signatures of two sets allow a link."""
    differ = " + ".join(f"bit_count((({x}s{i} ^ {y}s{i}) | shiftrightunsigned({x}s{i} ^ {y}s{i}, 1)) & {0x5555555555555555}L)" for i in (1, 2))
    return f"100 * least({x}n, {y}n) >= {PERCENT} * greatest({x}n, {y}n) and {differ} <= {DIFFERING}"


def _common(a: bytes, b: bytes) -> tuple[int, int, int]:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    return len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)


def likely(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union sketch doesn't rule out a link. Sets that are retained whole are compared exactly."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for sa, sb, na, nb in zip(pdf["sa"], pdf["sb"], pdf["na"], pdf["nb"], strict=True):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                twice = both[1:] == both[:-1]
                if na <= RETAINED and nb <= RETAINED:
                    common = int(twice.sum())
                    keep.append(100 * common >= PERCENT * (na + nb - common))
                else:
                    union = both[np.concatenate([[True], ~twice])]
                    k = min(RETAINED, len(union))
                    keep.append(int((both[1:][twice] <= union[k - 1]).sum()) >= ESTIMATE * k)
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]

    s = sketched.select("doc", "n", "sketch")
    a = s.toDF("a", "na", "sa")
    b = s.toDF("b", "nb", "sb")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb").mapInPandas(look, "a long, b long")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, hashes) of the documents whose id is in ids (doc)."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), PART_ROWS):
                part = pdf.iloc[a : a + PART_ROWS]
                yield pd.DataFrame({"doc": part["doc"], "hashes": [s.tobytes() for s in shingle_sets(part["t"].tolist())]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t"))
    return semi_join(rows, ids, "doc").mapInPandas(sets, "doc long, hashes binary").dropDuplicates(["doc"])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= PERCENT * union."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [_common(x, y) for x, y in zip(pdf["x"], pdf["y"], strict=True)]
            yield pdf.loc[np.array([100 * c >= PERCENT * (n + m - c) for c, n, m in found], bool), ["a", "b"]]

    return pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").mapInPandas(look, "a long, b long")


def _tile_links(a: pd.Series, b: pd.Series | None) -> list[tuple[int, int]]:
    """Links between the documents of two tiles, or of one, that join different components: a spanning forest of them."""
    sides = [a] if b is None else [a, b]
    ids = np.concatenate([np.frombuffer(t["ids"], np.int64) for t in sides])
    comp = np.concatenate([np.frombuffer(t["comps"], np.int64) for t in sides])
    size = np.concatenate([np.frombuffer(t["sizes"], np.int64) for t in sides])
    of = np.repeat(np.arange(len(ids)), size)
    _, value, times = np.unique(np.concatenate([np.frombuffer(t["hashes"], np.uint64) for t in sides]), return_inverse=True, return_counts=True)
    shared = times[value] > 1
    of, value = of[shared], np.unique(value[shared], return_inverse=True)[1].ravel()
    split = len(ids) if b is None else len(np.frombuffer(a["ids"], np.int64))
    common = np.zeros((split, len(ids) if b is None else len(ids) - split), np.float32)
    order = np.argsort(value, kind="stable")
    of, value = of[order], value[order]
    for low in range(0, int(value[-1]) + 1 if len(value) else 0, 2048):
        x, y = np.searchsorted(value, [low, low + 2048])
        there = np.zeros((len(ids), 2048), np.float32)
        there[of[x:y], value[x:y] - low] = 1
        common += there[:split] @ (there if b is None else there[split:]).T
    other = slice(None) if b is None else slice(split, None)
    both = size[:split, None] + size[None, other]
    hits = np.argwhere((100 * common >= PERCENT * (both - common)) & (comp[:split, None] != comp[None, other]))
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = parent.get(up, up)
            c = up
        return c

    out = []
    for i, j in hits:
        j = j if b is None else j + split
        x, y = root(int(comp[i])), root(int(comp[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return out


def linked_in_tiles(dense: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b) that join different components within dense lists (list, doc, rows, weight, comp), found on full sets;
    the tile of each document (doc, tile), and the pairs of tiles that are compared (tile_a, tile_b), the smaller first.

    A document's home is the largest of its dense lists, and homes are dealt into tiles of about TILE_ROWS documents, or
    of fewer that have about TILE_SHINGLES shingles together.
    Two tiles that meet in a list are compared as matrices, once, however many lists they meet in: rows are made for
    pairs of tiles and for links found, never for pairs of documents.
    """
    home = dense.groupBy("doc").agg(F.max_by(F.struct("list", "rows", "weight"), F.struct("rows", "list")).alias("h"), F.first("comp").alias("comp"))
    parts = F.ceil(F.greatest(F.col("h.rows") / TILE_ROWS, F.col("h.weight") / TILE_SHINGLES)).cast("int")
    tiled = materialize(home.select("doc", "comp", F.xxhash64("h.list", F.pmod(F.xxhash64("doc"), parts)).alias("tile")), "tiles")
    meet = dense.select("list", "doc").join(tiled.select("doc", "tile"), "doc").select("list", "tile").distinct()
    pairs = materialize(meet.toDF("list", "tile_a").join(meet.toDF("list", "tile_b"), "list").where("tile_a <= tile_b").select("tile_a", "tile_b").distinct(), "tile-pairs")

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = np.array([len(h) // 8 for h in pdf["hashes"]], np.int64)
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1].to_numpy(), "ids": [pdf["doc"].to_numpy(np.int64).tobytes()], "comps": [pdf["comp"].to_numpy(np.int64).tobytes()], "sizes": [sizes.tobytes()], "hashes": [b"".join(pdf["hashes"])]})

    sets = full_sets(docs, tiled.select("doc"), id_col, text_col)
    tiles = materialize(tiled.join(sets, "doc").groupBy("tile").applyInPandas(gather, "tile long, ids binary, comps binary, sizes binary, hashes binary"), "tile-sets")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, r in pdf.iterrows():
                a = r[["ids", "comps", "sizes", "hashes"]]
                b = None if r["tile_a"] == r["tile_b"] else pd.Series({c: r[f"{c}_b"] for c in ("ids", "comps", "sizes", "hashes")})
                yield pd.DataFrame(_tile_links(a, b), columns=["a", "b"]).astype(np.int64)

    other = tiles.toDF("tile_b", *(f"{c}_b" for c in ("ids", "comps", "sizes", "hashes")))
    links = pairs.join(tiles.withColumnRenamed("tile", "tile_a"), "tile_a").join(other, "tile_b").mapInPandas(look, "a long, b long")
    return links, tiled.select("doc", "tile"), pairs


def not_in_tiles(pairs: DataFrame, tiled: DataFrame, compared: DataFrame) -> DataFrame:
    """The pairs (a, b) whose tiles, if both have one, are not compared with each other as wholes."""
    of = pairs.join(tiled.toDF("a", "x"), "a", "left").join(tiled.toDF("b", "y"), "b", "left")
    of = of.select("a", "b", F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.least("x", "y")).alias("tile_a"), F.greatest("x", "y").alias("tile_b"))
    return of.join(compared, ["tile_a", "tile_b"], "left_anti").select("a", "b")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_shingles, component_id, kept.

    Rows with the same set are one class; its smallest id stands for it. Inverted lists of retained hash values propose
    pairs. Sizes and signatures spare most pairs that can't link. Every list is a star first, and a document is compared
    with that star of its lists with which it shares most lists; those that link become components, and only pairs of a
    list that are still in different components go on, so a group of n near copies costs about n comparisons a turn, not
    n * n. After STARS turns all pairs left are compared, those of lists with many left tile by tile, and pairs that tiles
    have compared are not compared again: no list, list length or number of partners is cut off. Links are confirmed on
    the full sets.

    Null and empty texts, and texts without words, have an empty set and no link. Ids are integers, and a row that repeats
    an id repeats its text; rows without an id only count as copies. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = materialize(sketches(docs, id_col, text_col).withColumn("doc", F.col("doc").cast("long")), "sketches")
    classes = smallest_of_group(rows.where("n > 0").select("doc", "same"), ["same"], "doc")
    reps = materialize(classes.where("doc = keep_id").select("doc").distinct().join(rows.where("n > 0").dropDuplicates(["doc"]), "doc"), "reps")
    lists = materialize(inverted_lists(reps, reps.count()), "lists")
    hot = hot_keys(lists, "list")
    sizes = reps.select("doc", "n", "s1", "s2")
    found = checked = component = sets = None
    for turn in range(STARS + 1):
        own = lists.join(sizes, "doc")
        own = own.withColumn("comp", F.col("doc")) if component is None else own.join(component, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        own = own.select("list", "doc", "n", "s1", "s2", "comp")
        mixed_lists = own.groupBy("list").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("list")
        own = materialize(join_by_key(own, mixed_lists, "list", hot), "open")
        by_comp = own.groupBy("list", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("w"))
        last = turn == STARS
        if last:
            # all pairs left: those of documents outside a list's largest component with one another and with that component
            by_list = by_comp.groupBy("list").agg(F.max_by("comp", F.struct("k", "comp")).alias("top"), F.sum("k").alias("rows"), F.sum("w").alias("weight"), ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("left"))
            by_list = materialize(by_list, "left")
            dense = join_by_key(own, by_list.where(F.col("left") > DENSE_PAIRS).select("list", "rows", "weight"), "list", hot).select("list", "doc", "rows", "weight", "comp")
            in_tiles, tiled, compared = linked_in_tiles(dense, docs, id_col, text_col)
            top = by_list.where(F.col("left") <= DENSE_PAIRS).select("list", "top")
            marked = join_by_key(own, top, "list", hot)
            rest = marked.where("comp <> top").select("list", *(F.col(x).alias(f"o_{x}") for x in ("doc", "n", "s1", "s2", "comp")))
            pairs = rest.join(marked, "list").where(f"comp <> o_comp and (comp = top or o_doc < doc) and {_alike('', 'o_')}").select(F.least("o_doc", "doc").alias("a"), F.greatest("o_doc", "doc").alias("b"))
        else:
            head = own.groupBy("list").agg(F.min_by(F.struct("doc", "comp", "n", "s1", "s2"), F.xxhash64("doc", F.lit(turn))).alias("h"))
            heads = join_by_key(own, head, "list", hot).where(f"comp <> h.comp and {_alike('', 'h.')}").groupBy("doc", F.col("h.doc").alias("head")).agg(F.count(F.lit(1)).alias("k"))
            nearest = heads.groupBy("doc").agg(F.max_by("head", F.struct("k", "head")).alias("head"))
            pairs = nearest.select(F.least("doc", "head").alias("a"), F.greatest("doc", "head").alias("b"))
        pairs = not_in_tiles(pairs.distinct(), tiled, compared) if last else pairs.distinct()
        pairs = materialize(pairs if checked is None else pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
        checked = pairs if checked is None else checked.union(pairs)
        close = materialize(likely(pairs, reps), "close")
        ids = close.select(F.col("a").alias("doc")).union(close.select("b")).distinct()
        sets_now = materialize(full_sets(docs, ids if sets is None else ids.join(sets.select("doc"), "doc", "left_anti"), id_col, text_col), "sets")
        sets = sets_now if sets is None else sets.union(sets_now)
        new = materialize(linked(close, sets).union(in_tiles) if last else linked(close, sets), "linked")
        found = new if found is None else found.union(new)
        component = materialize(connected_components(found).select(F.col("node").alias("doc"), F.col("component").alias("comp")), "components")
        if last:
            break
    by_class = rows.where("n > 0").groupBy("same").agg(F.min("doc").alias("doc")).join(component, "doc", "left").select("same", F.coalesce("comp", "doc").alias("component_id"))
    linked_rows = attach_by_key(rows.where("n > 0").select("doc", "n", "same"), ["same"], by_class, ["doc"])
    out = linked_rows.select("doc", "n", "component_id").union(rows.where("n = 0").select("doc", "n", F.col("doc").alias("component_id")))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component, the one with the smallest id; rows without an id stay, columns are unchanged.

    Where texts differ under one id each is a document of its own, after those of smaller ids.
    """
    digest = F.sha2(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"), 256)
    repeats = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(id_col)
    repeats = materialize(repeats, "repeated-ids")
    if repeats.isEmpty():
        return only_kept(docs, near_components(docs, id_col, text_col).where("kept").select(id_col), id_col)
    texts = materialize(semi_join(docs.select(id_col, digest.alias("_digest")), repeats, id_col).distinct(), "texts-of-ids")
    # the n-th text of an id gets the id times `most` plus n, which keeps the order of ids
    nth = materialize(rank_within(texts, id_col, ["_digest"], texts.count()), "nth-texts")
    most = nth.agg(F.max("rank")).head()[0] + 1
    low, high = docs.agg(F.min(id_col), F.max(id_col)).head()
    if max(-low, high) * most + most >= 2**63:
        raise ValueError(f"ids up to {max(-low, high)} leave no room to tell {most} texts of an id apart")
    name, mark = free_name(docs, "_row_id"), free_name(docs, "_digest")
    a, b = docs.withColumn(mark, digest).alias("a"), nth.select(F.col(id_col).alias("_of"), "_digest", "rank").alias("b")
    own = a.join(b, (F.col(f"a.{id_col}") == F.col("b._of")) & (F.col(f"a.{mark}") == F.col("b._digest")), "left")
    row_id = F.col(f"a.{id_col}").cast("long") * most + F.coalesce(F.col("b.rank"), F.lit(0))
    own = materialize(own.select(*(F.col(f"a.{c}") for c in docs.columns), row_id.alias(name)), "own-ids")
    kept = near_components(own.select(name, text_col), name, text_col).where("kept").select(name)
    return only_kept(own, kept, name).select(*docs.columns)
