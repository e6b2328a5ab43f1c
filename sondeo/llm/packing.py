"""Best-fit packing of token pieces into sequences by linear grouping."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_by_key, materialize, rank_within, small_batches
from .tokens import encoder

CAPACITY = 1024
END_ID = 2
#: Pieces over this share of the capacity are large; they go into configurations of groups, of at most four pieces.
LARGE = 1 / 5
#: Groups of large lengths, of about equal cardinality: the few sizes that configurations are optimised for.
GROUPS = 128
#: Columns priced per group at most; what is feasible by then is used, and best fit takes the rest.
PRICINGS = 24


PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most `capacity` tokens: the id column, piece, start, length, ids_crc32.

    A document is its tokens and END_ID. Only a longer one is cut: its last pieces are full, its first holds the rest.
    A null or empty text is END_ID alone.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for pdf in batches:
            out = []
            found = encode(t if isinstance(t, str) else "" for t in pdf[text_col])
            for key, text_ids in zip(pdf[id_col], found, strict=True):
                ids = np.append(text_ids, np.uint32(END_ID)).astype("<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                out += [(key, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            yield pd.DataFrame(out, columns=schema.names).astype({id_col: pdf[id_col].dtype})

    return docs.select(id_col, text_col).mapInPandas(cut, schema)


def _equal_groups(counts: np.ndarray, large: int, groups: int) -> np.ndarray:
    """For each length the length it is rounded up to: the largest of its group; groups hold about equally many pieces."""
    up = np.arange(len(counts))
    own = [n for n in range(large, len(counts)) if counts[n]]
    share = counts[own].sum() / max(1, groups)
    at, first = 0, 0
    for i, n in enumerate(own):
        at += counts[n]
        if at >= share or i == len(own) - 1:
            up[own[first] : n + 1] = n
            at, first = 0, i + 1
    return up


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By Gauss-Jordan steps with row pivots, element by element.

    This runs in the driver, whose threaded linear algebra library may stall after other work; matrices have one row per group.
    """
    m = len(matrix)
    both = np.concatenate([np.array(matrix, float), np.eye(m)], axis=1)
    for k in range(m):
        pivot = k + int(np.argmax(np.abs(both[k:, k])))
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        others = np.arange(m) != k
        both[others] -= both[others, k, None] * both[k]
    return both[:, m:]


def _configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (how many of each size) and how often each is used: the linear relaxation by column generation, rounded down.

    Every size is over a fifth of the capacity, so a configuration has at most four pieces.
    """
    m = len(sizes)
    size, need = np.array(sizes), np.array(demand, float)
    columns = [np.eye(m, dtype=int)[i] * (capacity // s) for i, s in enumerate(sizes)]
    inverse = np.diag(1 / (capacity // size))
    use = (inverse * need).sum(axis=1)
    # two of the sizes, or one, or none, by their sum: a configuration is two such pairs
    i, j = np.triu_indices(m + 1)
    total = np.append(size, 0)[i] + np.append(size, 0)[j]
    by_sum = np.argsort(total, kind="stable")[: int((total <= capacity).sum())]
    i, j, total = i[by_sum], j[by_sum], total[by_sum]
    sums, first = np.unique(total, return_index=True)
    rest = np.searchsorted(sums, capacity - sums, side="right") - 1
    for step in range(PRICINGS * m):
        price = np.append(np.maximum(inverse.sum(axis=0), 0), 0)
        worth = price[i] + price[j]
        best = np.maximum.reduceat(worth, first)
        upto = np.maximum.accumulate(best)
        at = int(np.argmax(best + upto[rest]))
        if best[at] + upto[rest[at]] < 1 + 1e-5:
            break
        column = np.zeros(m + 1, int)
        for k in (at, int(np.argmax(best[: rest[at] + 1]))):
            pair = first[k] + int(np.argmax(worth[first[k] : (first[k + 1] if k + 1 < len(first) else len(worth))]))
            column[i[pair]] += 1
            column[j[pair]] += 1
        column = column[:m]
        direction = (inverse * column).sum(axis=1)
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        columns[out] = column
        inverse[out] /= direction[out]
        others = np.arange(m) != out
        inverse[others] -= direction[others, None] * inverse[out]
        if step % 50 == 49:
            inverse = _inverse(np.array(columns).T)
        use = np.maximum((inverse * need).sum(axis=1), 0)
    return [(tuple(int(x) for x in c), int(u + 1e-9)) for c, u in zip(columns, use, strict=True) if int(u + 1e-9)]


def _best_fit(classes: dict[int, list[tuple[int, int]]], left: list[tuple[int, int, int]], next_bin: int, capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best fit, longest first, of runs of equal pieces into runs of equal bins.

    classes: by free room, runs (first bin, bins). left: runs (length, first rank, pieces). Returns runs (length, first
    rank, first bin, offset) of pieces that go to consecutive bins, and the next unused bin. Works on runs, so its cost
    follows the number of different lengths and rooms, not of pieces.
    """
    rooms = np.zeros(capacity + 1, bool)
    for r, runs in classes.items():
        rooms[r] = bool(runs)
    out = []
    for length, rank, count in sorted(left, reverse=True):
        while count:
            found = np.flatnonzero(rooms[length:])
            if len(found):
                room = length + int(found[0])
                first, bins = classes[room].pop()
                took = min(bins, count)
                if took < bins:
                    classes[room].append((first + took, bins - took))
                rooms[room] = bool(classes[room])
            else:
                per = capacity // length
                room, first, took = capacity, next_bin, -(-count // per)
                next_bin += took
            out.append((length, rank, first, capacity - room, took))
            classes[room - length].append((first, took)) if room - length else None
            if room - length:
                rooms[room - length] = True
            filled = min(took, count)
            if filled < took:  # bins opened for several each stay empty until the next turn
                raise AssertionError
            rank, count = rank + filled, count - filled
    return [x[:4] for x in out], next_bin


def arrange(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS, large_share: float = LARGE) -> list[tuple[int, int, int, int]]:
    """Where pieces go: runs (length, first rank, first sequence, offset). Piece first rank + i of that length, up to the next run, is in sequence first sequence + i.

    counts: pieces by length, 0 to capacity. Full pieces have sequences of their own. Large lengths are rounded up
    within groups of equal cardinality; configurations of those few sizes are optimised for all of a group's pieces; then
    the actual pieces, longest first, take their group's places; what rounding left and the small pieces go best fit,
    longest first, into the room that the actual pieces leave.
    """
    counts = np.array(counts, np.int64)
    out: list[tuple[int, int, int, int]] = []
    if counts[capacity]:
        out.append((capacity, 0, 0, 0))
    next_bin = int(counts[capacity])
    large = max(capacity // 5 + 1, int(capacity * large_share))
    body = counts.copy()
    body[capacity] = 0
    up = _equal_groups(body, large, groups)
    members: dict[int, list[list[int]]] = defaultdict(list)  # by rounded size: runs [length, rank, pieces], longest first
    for n in range(capacity - 1, large - 1, -1):
        if body[n]:
            members[int(up[n])].append([n, 0, int(body[n])])
    sizes = sorted(members, reverse=True)
    classes: dict[int, list[tuple[int, int]]] = defaultdict(list)
    if sizes:
        for column, times in _configurations(sizes, [sum(x[2] for x in members[s]) for s in sizes], capacity):
            slots = [s for s, k in zip(sizes, column, strict=True) for _ in range(k)]
            cuts, runs = {0, times}, []
            for s in slots:  # the actual pieces of each place, as runs over the configuration's sequences
                own, at = [], 0
                while at < times and members[s]:
                    n, rank, have = members[s][0]
                    took = min(have, times - at)
                    own.append((at, at + took, n, rank))
                    members[s][0] = [n, rank + took, have - took]
                    if have == took:
                        members[s].pop(0)
                    at += took
                    cuts.add(at)
                runs.append(own)
            edges = sorted(cuts)
            for a, b in zip(edges, edges[1:], strict=False):
                offset = 0
                for own in runs:
                    for lo, hi, n, rank in own:
                        if lo <= a and b <= hi:
                            out.append((n, rank + a - lo, next_bin + a, offset))
                            offset += n
                classes[capacity - offset].append((next_bin + a, b - a))
            next_bin += times
    rest = [tuple(x) for s in sizes for x in members[s]] + [(n, 0, int(body[n])) for n in range(1, large) if body[n]]
    more, _ = _best_fit(classes, rest, next_bin, capacity)
    return out + more


def _part_of(position: str, most: int, total: int, part_rows: int = 20_000) -> Column:
    """A part for rank_within() that grows with the position, so that about part_rows of total rows are in each."""
    return F.expr(f"cast({position} div {most // max(64, -(-total // part_rows)) + 1} as int)")


def place(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, groups: int = GROUPS, ordered: bool = False) -> DataFrame:
    """pieces with sequence_id and offset. ordered: pieces have _position; it decides who goes first, and is left out.

    The driver gets one count per length (at most `capacity`) and arranges runs of equal pieces; a piece's rank among
    those of its length then tells its place, so no task and not the driver ever lists the pieces. With positions, pieces
    of a length take their places in that order, and a sequence is numbered by the position of the piece that begins it.
    """
    found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"), (F.max("_position") if ordered else F.lit(0)).alias("most")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["n"]
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for n, rank, first, offset in arrange(counts, capacity, groups):
        runs[n].append((rank, first, offset))
    tables = {n: np.array(sorted(v), np.int64).T for n, v in runs.items()}
    total = int(counts.sum())
    if ordered:
        part = _part_of("_position", max((r["most"] for r in found), default=0), total)
        ranked = rank_within(pieces, "length", ["_position", id_col, "piece", "start", "ids_crc32"], total, part=part)
    else:
        ranked = rank_within(pieces, "length", [id_col, "piece"], total)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank, sequence, offset = pdf["rank"].to_numpy(), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for n, at in pdf.groupby("length").indices.items():
                starts, firsts, offsets = tables[n]
                k = np.searchsorted(starts, rank[at], side="right") - 1
                sequence[at], offset[at] = firsts[k] + rank[at] - starts[k], offsets[k]
            yield pdf.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    placed = ranked.mapInPandas(look_up, schema)
    if not ordered:
        return placed
    placed = materialize(placed, "placed")
    heads = placed.where("offset = 0").select(F.lit(0).alias("_all"), "sequence_id", "_position")  # one of each sequence
    numbers = rank_within(heads, "_all", ["_position", "sequence_id"], total, part=part).select("sequence_id", "rank")
    return placed.join(numbers, "sequence_id").withColumn("sequence_id", F.col("rank")).select(*(c for c in placed.columns if c != "_position"))


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, groups: int = GROUPS, order: DataFrame | None = None) -> DataFrame:
    """token_pieces() and place(): every piece of every row, none left out.

    Rows that repeat an id are documents of their own. Ties of length are arranged by id and piece. An empty table gives
    no rows. Columns other than the two named are not read. order: (id_col, _position) with a row for each id of
    docs (mixing.positions()); sequences are then filled and numbered by it.
    """
    pieces = materialize(token_pieces(docs, vocabulary, id_col, text_col, capacity), "pieces")
    if order is not None:
        pieces = materialize(attach_by_key(pieces, [id_col], order, ["piece", "ids_crc32"]), "ordered-pieces")
    return place(pieces, id_col, capacity, groups, ordered=order is not None)
