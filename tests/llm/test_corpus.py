"""Packing, mixing, search and the pipeline."""

import faulthandler
import math
import zlib
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pytest

import corpus_pipeline
from sondeo.llm import ann, mixing, packing, queries
from tests.llm.conftest import prose
from tests.oracle import SMALL


@contextmanager
def within(seconds):
    """Ends the test process, with all stacks, if the body takes longer: a stalled library call can't be interrupted."""
    faulthandler.dump_traceback_later(seconds, exit=True)
    try:
        yield
    finally:
        faulthandler.cancel_dump_traceback_later()


def bins_of(counts, runs, capacity):
    by, bins = {}, {}
    for n, rank, first, offset in runs:
        by.setdefault(n, []).append((rank, first, offset))
    for n in range(1, capacity + 1):
        own = sorted(by.get(n, []))
        assert bool(own) == bool(counts[n]) and (not own or own[0][0] == 0)
        for k, (rank, first, offset) in enumerate(own):
            end = own[k + 1][0] if k + 1 < len(own) else counts[n]
            for r in range(rank, end):
                bins.setdefault(first + r - rank, []).append((offset, n))
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("kind", ["lognormal", "uniform", "thirds", "small", "few", "one", "none"])
def test_arrangements_are_valid_and_tight(kind):
    rng = np.random.default_rng(1)
    lengths = {"lognormal": np.minimum(rng.lognormal(6, 1, 4000).astype(int) + 1, 1024), "uniform": rng.integers(1, 1025, 4000), "thirds": rng.integers(330, 360, 4000), "small": rng.integers(1, 90, 4000), "few": np.array([1024, 512, 512, 700, 1, 1]), "one": np.array([1]), "none": np.zeros(0, int)}[kind]
    counts = np.bincount(lengths, minlength=1025)
    used = bins_of(counts, packing.arrange(counts), 1024)
    least = math.ceil(lengths.sum() / 1024)
    if kind == "thirds":
        least = 1440  # three a sequence only while their mean is below 1024 / 3
    assert used <= least * 1.04 + 2


def test_pack_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    rows = [(1, "short"), (2, None), (3, ""), (4, prose(1, 3000)), (5, "<|endoftext|> ordinary"), (6, "漢字 ñ é 👍"), (None, "x"), (7, prose(2, 400)), (7, prose(2, 400))]
    got = packing.pack(docs(rows), queries.vocabulary()).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(i for i, _ in rows)
    texts = dict(rows)
    for r in got:
        ids = np.array(tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2], "<u4")
        assert r.length <= 1024 and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert r.length == 1024 or r.piece == 0
    for key, n in Counter(r.sequence_id for r in got).items():
        at = 0
        for r in sorted((r for r in got if r.sequence_id == key), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack(docs([(1, "x")]).where("doc_id > 1"), queries.vocabulary()).count() == 0


def test_very_long_texts_of_one_kind_are_packed(docs):
    """A run of a million spaces was more than another library's stack could hold."""
    rows = [(i, c * 1_000_000) for i, c in enumerate((" ", "\n", "a", "7"))]
    got = packing.pack(docs(rows), queries.vocabulary()).collect()
    assert {r.doc_id for r in got} == {0, 1, 2, 3} and all(r.length <= 1024 for r in got)


def fewest_bins(lengths, capacity):
    """By trying every place for each piece, longest first."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                left = list(rooms)
                left[left.index(room)] -= lengths[i]
                put(i + 1, left)
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def test_arrangements_against_all_packings():
    rng = np.random.default_rng(4)
    more = 0
    for _ in range(60):
        capacity = int(rng.integers(8, 24))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 10))).tolist()
        used = bins_of(np.bincount(lengths, minlength=capacity + 1), packing.arrange(np.bincount(lengths, minlength=capacity + 1), capacity, groups=4), capacity)
        least = fewest_bins(lengths, capacity)
        assert least <= used <= least + 1
        more += used - least
    assert more <= 12


def test_inverse_without_a_library():
    rng = np.random.default_rng(2)
    for m in (1, 3, 40):
        x = rng.integers(0, 3, (m, m)) + np.eye(m) * 5
        assert np.allclose((packing._inverse(x)[:, :, None] * x[None]).sum(axis=1), np.eye(m))


@pytest.mark.parametrize("weights", [{"a": 1.0}, {"a": 3, "b": 1}, {"a": 0.61, "b": 0.3, "c": 0.07, "d": 0.02}])
def test_schedule_stays_within_a_block(weights):
    slots = mixing.whole_weights(weights, 200)
    order = mixing.schedule(slots)
    assert Counter(order) == slots
    seen = Counter()
    for t, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[x] - t * n / len(order)) < 1 for x, n in slots.items())


def test_plan_places_every_block_once():
    blocks = {"a": 1000, "b": 37, "c": 5, "d": 1}
    phases = mixing.plan(blocks, {"a": 2, "b": 1, "c": 1, "d": 1}, 64)
    at = np.concatenate([mixing.slot_of(phases, s, np.arange(n)) for s, n in blocks.items()])
    assert sorted(at.tolist()) == list(range(sum(blocks.values())))


def test_deviations_do_not_add_up_over_phases():
    """Against shares that flow: each slot gives every source that still has blocks its weight among those."""
    rng = np.random.default_rng(8)
    for _ in range(12):
        n = int(rng.integers(3, 14))
        blocks = {f"s{i}": int(rng.integers(1, 400)) for i in range(n)}
        weights = {s: float(rng.integers(1, 50)) for s in blocks}
        order = {}
        phases = mixing.plan(blocks, weights, 256)
        for s, k in blocks.items():
            for x in mixing.slot_of(phases, s, np.arange(k)):
                order[int(x)] = s
        assert sorted(order) == list(range(sum(blocks.values())))
        behind, seen = dict.fromkeys(blocks, 0.0), Counter()
        for t in range(len(order)):
            going = {s: slots for s, slots in mixing.whole_weights({s: weights[s] for s in blocks if seen[s] < blocks[s]}, 256).items()}
            total = sum(going.values())
            for s, slots in going.items():
                behind[s] += slots / total
            behind[order[t]] -= 1
            seen[order[t]] += 1
            for s in [s for s in going if seen[s] == blocks[s]]:  # what it is behind goes to the others
                rest = behind.pop(s)
                others = sum(going[x] for x in behind if x in going)
                for x in behind:
                    behind[x] += rest * going[x] / others
            assert all(abs(x) < 2 for x in behind.values())


def test_mix_against_a_list(spark):
    """Sources as queues of blocks that the schedule empties one by one, ids in the order of mix()."""
    rows = [(i, "ab"[i % 3 == 0]) for i in range(90)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"a": 1, "b": 3}, block_docs=4, period=32).collect()
    queues = {s: [] for s in "ab"}
    for r in sorted((r for r in got), key=lambda r: (r.block, r.position)):
        queues[r.source].append(r.doc_id)
    turns = [x for x in mixing.schedule(mixing.whole_weights({"a": 1, "b": 3}, 32))] * 9
    want = []
    for s in turns:
        if not all(queues.values()):
            break
        want += queues[s][:4]
        del queues[s][:4]
    assert [r.doc_id for r in sorted(got, key=lambda r: r.position)][: len(want)] == want and len(want) > 30


def test_mix(spark, docs):
    rows = spark.createDataFrame([(i, f"s{min(i % 7, 2)}" if i % 11 else None, 5) for i in range(700)] + [(None, "s1", 5)], "doc_id long, source string, position int").repartition(5)
    got = mixing.mix(rows, {"s0": 1, "s1": 1, "s2": 2}, block_docs=4, period=32).collect()
    assert len(got) == 701 and len({r.position for r in got}) == 701 and {r.source for r in got} == {"", "s0", "s1", "s2"}
    for r in got:
        assert r.position // 4 == r.slot
    assert [r.position for r in sorted(got, key=lambda r: str(r.doc_id))] == [r.position for r in sorted(mixing.mix(rows.repartition(2), {"s0": 1, "s1": 1, "s2": 2}, block_docs=4, period=32).collect(), key=lambda r: str(r.doc_id))]
    table = docs([(i, "t") for i in range(50)] + [(None, "u"), (3, "t")])
    mixed = mixing.in_mixed_order(table)
    assert mixed.columns == table.columns and mixed.count() == 52
    assert mixing.mix(rows.where("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(rows, {"s0": 0})


def exact_neighbours(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            out[i] = sorted(((-float((x * q).sum()), j) for j, x in good if j != i))[:k]
    return out


def test_nearest_with_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(600)] + [(1000 + i, [1.0] * 8) for i in range(60)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] + [1.0] * 7), (2080, [float("inf")] * 8), (None, [1.0] * 8), (2100, [])]
    df = spark.createDataFrame([(i, v, 0, 0.5) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double").repartition(4)
    want = exact_neighbours(rows, 20, 5)
    got = {}
    for r in sorted(ann.nearest(df, 20, 5).collect(), key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    hit = sum(len({j for _, j in want[q]} & {j for _, j, _ in got[q]}) for q in want)
    assert hit >= 0.97 * 5 * len(want)
    assert [j for _, j, _ in got[1000]] == [j for _, j in want[1000]]
    assert all([r for r, _, _ in v] == list(range(1, 6)) for v in got.values())
    assert all(s == pytest.approx(-w, rel=1e-12) for q in want for (w, _), (_, _, s) in zip(want[q], got[q], strict=True) if hit == 5 * len(want))
    assert ann.nearest(df.where("vec_id = 2000"), 20, 5).count() == 0 and ann.nearest(df.where("vec_id = 20"), 20, 5).count() == 0


def test_nearest_beyond_single_precision(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.integers(-140, 140)).tolist()) for i in range(400)] + [(500, [1e300] * 8), (520, [-1e300] * 8), (540, [5e-324] * 8)]
    want = exact_neighbours([r for r in rows if r[0] < 500], 20, 5)
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 5).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() | {500, 520, 540} and all(len(v) == 5 for v in got.values())
    hit = sum(len({j for _, j in want[q]} - {j for j, _ in got[q]}) for q in want)
    assert hit <= 2 * len(want)  # those with ids from 500 on take places
    assert max(got[500], key=lambda x: x[1])[1] > 1e150


def test_queries_go_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(500)] + [(40, [1.0] * 8)], "vec_id long, embedding array<double>")
    once = sorted(ann.nearest(df, 20, 5).collect())
    monkeypatch.setattr(ann, "QUERY_BYTES", 300)
    assert sorted(ann.nearest(df, 20, 5).collect()) == once


def test_recall_on_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    hit = n = 0
    found = queries.op8_nearest(spark, sf).toPandas()
    for q, own in found.groupby("query_id"):
        s = (x * x[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(own["vec_id"]))
        n += 20
    assert hit / n >= 0.9 and len(found) == n


def test_residuals_along_vectors_cost_more():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 64)).astype(np.float32)
    books = ann.Codebooks.fit(x)

    def along(codes):
        decoded = books.centres[np.arange(len(books.centres)), codes].reshape(len(x), -1)[:, :64]
        return np.abs(((x - decoded) * x).sum(axis=1)).mean()

    assert along(books.encode(x, 2)) < 0.9 * along(books.encode(x, 0))


def test_weights_reach_the_rows_of_the_pipeline(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    many = [s for s, _ in Counter(source.values()).most_common(2)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    found = []
    for weights in ({many[0]: 1000.0, many[1]: 1.0}, {many[0]: 1.0, many[1]: 1000.0}):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        rows = corpus_pipeline.run(spark, SMALL).collect()
        again = corpus_pipeline.run(spark, SMALL).collect()
        assert sorted(rows) == sorted(again)
        heads = sorted((r for r in rows if r.offset == 0), key=lambda r: r.sequence_id)
        assert [r.sequence_id for r in heads] == list(range(len({r.sequence_id for r in rows})))
        at = {r.doc_id: r.position for r in mixing.mix(docs.select("doc_id", "source"), weights).collect()}
        assert all(at[a.doc_id] <= at[b.doc_id] for a, b in zip(heads, heads[1:], strict=False))
        end = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == end.get(r.sequence_id, 0)
            end[r.sequence_id] = r.offset + r.length
        assert max(end.values()) <= packing.CAPACITY
        found.append((rows, [source[r.doc_id] for r in heads[: len(heads) // 4]]))
    (one, first), (two, second) = found
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in one) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in two)
    assert {(r.doc_id, r.piece, r.sequence_id) for r in one} != {(r.doc_id, r.piece, r.sequence_id) for r in two}
    assert first.count(many[0]) > second.count(many[0]) and first.count(many[1]) < second.count(many[1])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_classifier":
            bad = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 0").collect()}
            good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
            assert len(bad - after.keys()) >= 0.9 * len(bad) and len(good & after.keys()) >= 0.97 * len(good)
        elif name == "exact_dedup":
            first = {}
            for i, t in sorted(before.items()):
                first.setdefault(" ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t)), i)
            assert after.keys() == set(first.values())
        elif name == "near_dedup":
            from tests.llm.test_dedup import brute_near

            assert after.keys() == {i for i, (_, c) in brute_near(list(before.items())).items() if i == c}
        else:
            assert after == before
        before = after
        docs = out.cache()
    with within(120):  # what packing computes in the driver must not stall after the other stages
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == before.keys()
    assert len(corpus_pipeline.run(spark, SMALL).collect()) == len(pieces)


def test_written_tables_go_when_nothing_reads_them(spark, tmp_path, monkeypatch):
    from sondeo.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    left = lambda: sorted(p.name.split("-")[1] for p in tmp_path.iterdir())

    @common.tidied
    def inner(spark):
        a = common.materialize(spark.range(5), "a")
        return common.materialize(a.selectExpr("id + 1 as id"), "b").where("id > 1")

    @common.tidied
    def outer(spark):
        return common.materialize(inner(spark).join(common.materialize(spark.range(3), "c"), "id"), "d")

    assert sorted(r.id for r in inner(spark).collect()) == [2, 3, 4, 5] and left() == ["b"]
    assert [r.id for r in outer(spark).collect()] == [2] and left() == ["b", "d"]

    @common.tidied
    def failing(spark):
        common.materialize(spark.range(5), "e")
        raise ValueError

    with pytest.raises(ValueError):
        failing(spark)
    assert left() == ["b", "d"]
    n = queries.queries()["op9_exact_dedup"](spark, SMALL).count()
    assert n == spark.read.parquet(f"{SMALL}/documents.parquet").count() and left() == ["b", "d", "rows"]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from sondeo.llm import common

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://x", getConf=lambda: SimpleNamespace(get=lambda *_: None)))
    with pytest.raises(RuntimeError):
        common.shared_dir(cluster)


def test_samples_are_the_same_on_every_run(spark):
    from sondeo.llm import common

    rows = [(i % 40, f"text {i}") for i in range(400)] + [(None, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    samples = [common.bounded_sample(table.repartition(k), "doc_id", 16).collect() for k in (1, 3, 7)]
    assert samples[0] == samples[1] == samples[2] and len(samples[0]) == 16
