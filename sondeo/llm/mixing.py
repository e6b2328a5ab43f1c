"""Mixing sources to target weights by proportionate-fair scheduling of blocks."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import rank_within

BLOCK_DOCS = 8
#: Slots of a schedule's period at least; weights are rounded to whole slots of it.
PERIOD = 2048


def whole_weights(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots per period, at least one each, by largest remainders."""
    period = max(period, 16 * len(weights))
    total = sum(weights.values())
    exact = {s: w * period / total for s, w in sorted(weights.items())}
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: max(0, period - sum(slots.values()))]:
        slots[s] += 1
    return slots


def schedule(slots: dict[str, int], lag: dict[str, Fraction] | None = None) -> list[str]:
    """One period, earliest deadline first.

    Block k of a source with weight w (its share of the slots) is released at floor((k - lag) / w) and due by
    ceil((k + 1 - lag) / w); of the released blocks, the one due first goes next. lag: by how many blocks sources are
    behind their shares when the period begins, none by default. Without lags every source is then less than one block
    from its share. A block of a source that is behind may have been due before: it goes first.
    """
    period = sum(slots.values())
    weight = {s: Fraction(n, period) for s, n in slots.items()}
    lag = lag or {}
    release = lambda s, k: max(0, (k - lag.get(s, 0)) // weight[s])
    due = lambda s, k: -(-(k + 1 - lag.get(s, 0)) // weight[s])
    waiting = [(release(s, 0), s, 0) for s in sorted(slots)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out: list[str] = []
    for t in range(period):
        while waiting and (waiting[0][0] <= t or not ready):  # no slot stays empty
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, k), s, k))
        _, s, k = heapq.heappop(ready)
        out.append(s)
        if k + 1 < slots[s]:
            heapq.heappush(waiting, (release(s, k + 1), s, k + 1))
    return out


def plan(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[dict]:
    """Phases, each until a source has no block left; the others go on with their weights among themselves.

    A phase: base (its first slot), first (blocks of each source that went before), slots, of (slots of the period by
    source). What a source is behind its share, or ahead, at the end of a phase goes into the next one, so that
    deviations don't add up; that of the source which has ended is shared by weight.
    """
    left, first, base, phases = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0, []
    lag: dict[str, Fraction] = {}
    while left:
        slots = whole_weights({s: weights[s] for s in left}, period)
        order = schedule(slots, lag)
        of = {s: [] for s in left}
        for t, s in enumerate(order):
            of[s].append(t)
        phases.append({"base": base, "first": {s: first[s] for s in left}, "period": len(order), "of": {s: np.array(v, np.int32) for s, v in of.items()}})
        last = min((n - 1) // slots[s] * len(order) + of[s][(n - 1) % slots[s]] for s, n in left.items())  # the slot in which a source ends
        full, rest = divmod(last + 1, len(order))
        for s in list(left):
            took = full * slots[s] + int(np.searchsorted(of[s], rest))
            lag[s] = (lag.get(s, 0) + Fraction((last + 1) * slots[s], len(order)) - took).limit_denominator(1 << 20)
            left[s] -= took
            first[s] += took
            if not left[s]:
                del left[s]
        ended = sum(lag.pop(s) for s in list(lag) if s not in left)
        total = sum(slots[s] for s in left)
        lag = {s: x + ended * Fraction(slots[s], total) for s, x in lag.items()}
        base += last + 1
    return phases


def slot_of(phases: list[dict], source: str, block: np.ndarray) -> np.ndarray:
    out = np.zeros(len(block), np.int64)
    for p in phases:
        if source in p["of"]:
            at = block - p["first"][source]
            own, here = p["of"][source], at >= 0
            out[here] = p["base"] + at[here] // len(own) * p["period"] + own[at[here] % len(own)]
    return out


def mix(docs: DataFrame, weights: dict[str, float] | None = None, smoothing: float = 0.5, id_col: str = "doc_id", source_col: str = "source", block_docs: int = BLOCK_DOCS, period: int = PERIOD) -> DataFrame:
    """One row per row of docs: id_col, source, block, slot, position.

    A source's documents, in a fixed order, make blocks of block_docs; slot is the block's place in the schedule, and
    position the document's place in the mix (unique; slot * block_docs plus its place in the block, so a source's last,
    shorter block leaves a gap). weights: target weight by source; sources that have none there, and all without
    weights, get their number of documents to the power of smoothing. Null source is the source "". No document is left
    out: when a source has no more, the others share its slots. An empty table gives no rows. The driver holds one number
    per source and a period of slots per phase, nothing that grows with the documents: with n sources at most n phases of
    max(period, 16 * n) slots of four bytes, 1 MB for 100 sources.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    sizes = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    target = {s: float((weights or {}).get(s, n**smoothing)) for s, n in sizes.items()}
    if bad := [s for s, w in target.items() if not w > 0]:
        raise ValueError(f"target weights must be positive: {bad}")
    phases = plan({s: -(-n // block_docs) for s, n in sizes.items()}, target, period)
    ranked = rank_within(rows, "source", ["_id"], sum(sizes.values()))
    schema = T.StructType([ranked.schema["_id"], T.StructField("source", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("block", "slot", "position"))])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank = pdf["rank"].to_numpy()
            slot = np.zeros(len(pdf), np.int64)
            for s, at in pdf.groupby("source").indices.items():
                slot[at] = slot_of(phases, s, rank[at] // block_docs)
            yield pdf[["_id", "source"]].assign(block=rank // block_docs, slot=slot, position=slot * block_docs + rank % block_docs)

    return ranked.mapInPandas(place, schema).withColumnRenamed("_id", id_col)


def positions(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id_col, _position): one row per id, its first position in the mix; the same for the same documents and weights."""
    return mix(docs, weights, id_col=id_col).groupBy(id_col).agg(F.min("position").alias("_position"))


def in_mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id") -> DataFrame:
    """docs, all of them and unchanged, sorted by their position in the mix."""
    a, b = docs.alias("a"), positions(docs, weights, id_col).alias("b")
    return a.join(b, F.col(f"a.{id_col}").eqNullSafe(F.col(f"b.{id_col}"))).orderBy("b._position").select("a.*")
