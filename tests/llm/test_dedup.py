"""Exact, near and substring deduplication against brute force."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sondeo.llm import exact_dedup, near_dedup, queries, suffix_dedup, suffix_sort
from sondeo.llm.components import connected_components
from tests.llm.conftest import prose
from tests.oracle import SMALL, same

SMALLER = "/root/testdata/sf0.001"


def cases():
    base = prose(1, 80)
    near = base.replace("w1x7919 ", "changed ")
    long = prose(2, 30_000)
    rows = [(i, base) for i in (30, 20, 10)] + [(40, near), (41, near + " and some more"), (50, None), (51, ""), (52, " \t\n"), (60, "one two"), (61, "One  two"), (62, "three"), (70, long), (71, long + " end"), (80, base + "\n" + base), (None, base), (None, "alone"), (20, base)]
    rows += [(100 + k, " ".join(prose(1, 80).split()[k : k + 60])) for k in range(15)]
    rows += [(200 + k, prose(300 + k, 60) + " " + prose(9, 25)) for k in range(80)]  # a passage that many share
    return rows


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_near(rows):
    sets = {(i, t): shingles(t) for i, t in rows}
    ids = sorted({i for i, _ in rows if i is not None})
    of = {i: s for (i, _), s in sets.items() if i is not None}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and of[a] and of[b] and 100 * len(of[a] & of[b]) >= 75 * len(of[a] | of[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(of[i]), find(i)) for i in ids}


def test_near_components(docs):
    rows = cases()
    want = brute_near(rows)
    got = near_dedup.near_components(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_near_dense_lists_go_through_tiles(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "DENSE_PAIRS", 5)
    monkeypatch.setattr(near_dedup, "TILE_ROWS", 16)
    monkeypatch.setattr(near_dedup, "STARS", 0)
    words = prose(5, 120).split()
    rows = [(k, " ".join(w if (j * 31 + k * k) % 17 > 1 or j % 9 else f"c{k}" for j, w in enumerate(words))) for k in range(120)]
    want = brute_near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs(rows)).collect()} == want


def test_near_compares_few_pairs_of_large_groups(docs, monkeypatch):
    """Near copies with edits of their own, and documents that share a passage but are not alike: a document meets few others one by one."""
    counts, likely = [], near_dedup.likely
    monkeypatch.setattr(near_dedup, "likely", lambda pairs, sketched: counts.append(pairs.count()) or likely(pairs, sketched))
    monkeypatch.setattr(near_dedup, "DENSE_PAIRS", 500)
    words, passage = prose(5, 150).split(), prose(6, 60)
    rows = [(k, " ".join(f"c{k}" if j in ((k * 37) % 150, (k * k * 11 + 70) % 150) else w for j, w in enumerate(words))) for k in range(200)]
    rows += [(1000 + k, f"{prose(7000 + k, 20 + k % 10)} {' '.join(passage.split()[k % 7 :])}") for k in range(200)]
    want = brute_near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs(rows)).collect()} == want
    assert all(n <= len(rows) for n in counts) and len(counts) == near_dedup.STARS + 1, counts


def test_near_pairs_of_compared_tiles_go_once(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (3, 4), (5, 6)], "a long, b long")
    tiled = spark.createDataFrame([(1, 10), (2, 10), (3, 9), (4, 8)], "doc long, tile long")
    compared = spark.createDataFrame([(10, 10), (9, 10)], "tile_a long, tile_b long")
    assert sorted(map(tuple, near_dedup.not_in_tiles(pairs, tiled, compared).collect())) == [(3, 4), (5, 6)]


def test_near_on_small_table(spark):
    docs = spark.read.parquet(f"{SMALLER}/documents.parquet")
    want = brute_near([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_near_dedup(spark, SMALLER).collect()} == want


def prefix_filter_join(rows):
    """Components by an exact join: shingles rarest first, a quarter of a set and one more must hold a common one."""
    sets = {i: shingles(t) for i, t in rows}
    count = {}
    for s in sets.values():
        for x in s:
            count[x] = count.get(x, 0) + 1
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in sorted(sets.items()):
        near = set()
        for x in sorted(s, key=lambda x: (count[x], x))[: len(s) - -(-3 * len(s) // 4) + 1]:
            near.update(index.get(x, ()))
            index.setdefault(x, []).append(i)
        for j in near:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_equals_a_prefix_filter_join(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = prefix_filter_join(rows)
    assert sum(n > near_dedup.RETAINED for n, _ in want.values()) > 100
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_near_dedup(spark, sf).collect()} == want


def test_near_with_long_lists_and_large_sets(docs):
    """Long lists (a passage in 400 documents), and chains of large sets on both sides of the threshold."""
    passage = prose(900, 160)
    rows = [(k, f"{prose(1000 + k, 90)} {passage} {prose(3000 + k, 60 + k % 50)}") for k in range(400)]
    for c in range(40):
        words = prose(6000 + c, 500).split()
        for step in range(4):
            at = 137 * step % 300
            words[at : at + 30 + c] = prose(9000 + 10 * c + step, 30 + c).split()
            rows.append((1000 + 10 * c + step, " ".join(words)))
    want = prefix_filter_join(rows)
    sizes = {}
    for _, c in want.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert {1, 4} <= set(sizes.values())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs(rows)).collect()} == want


def test_chances_of_missing_a_link():
    assert all(x < 1e-12 for x in near_dedup.miss_chances().values())
    assert all(x < 1e-20 for x in near_dedup.miss_chances(0.9).values())


def test_lists_of_hot_keys_join_apart(spark):
    from sondeo.llm import common

    rows = spark.createDataFrame([(1, k) for k in range(50)] + [(2, 7), (3, 8)], "list long, doc long")
    values = spark.createDataFrame([(1, "a"), (2, "b")], "list long, v string")
    want = sorted(map(tuple, rows.join(values, "list").select("list", "doc", "v").collect()))
    hot = common.hot_keys(rows, "list", 10)
    assert [r["list"] for r in hot.collect()] == [1] and common.hot_keys(rows, "list", 100) is None
    for h, most in ((hot, 10), (hot, 0), (None, 10)):
        assert sorted(map(tuple, common.join_by_key(rows, values, "list", h, most).select("list", "doc", "v").collect())) == want


def test_drop_near_copies_keeps_columns_and_one_of_each(docs):
    table = docs(cases())
    out = near_dedup.drop_near_copies(table)
    assert out.columns == table.columns
    ids = [r.doc_id for r in out.collect()]
    known = [i for i in ids if i is not None]
    assert len(known) == len(set(known)) and {10, 50, 51, 52, 60, 62, 70} <= set(known) and not {20, 30, 40, 61, 71, 80} & set(known)
    assert ids.count(None) == 2


def test_different_texts_of_one_id_stay(docs):
    one, two = prose(1, 80), prose(2, 80)
    rows = [(5, one), (5, two), (5, two), (3, "x  y"), (4, "x y"), (4, "other"), (9, one), (None, two)]
    out = exact_dedup.drop_exact_copies(docs(rows))
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted([(5, one), (5, two), (3, "x  y"), (4, "other"), (0, two)])
    near = [(5, one), (5, two), (5, two), (3, two + " end"), (9, one + " end"), (7, ""), (7, ""), (None, two), (-2, prose(3, 80)), (-2, prose(4, 80))]
    table = docs(near)
    out = near_dedup.drop_near_copies(table)
    assert out.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted([(5, one), (3, two + " end"), (7, ""), (0, two), (-2, prose(3, 80)), (-2, prose(4, 80))])


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 120)] + [(7, 7), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 120)}, 200: 200, 201: 200}
    assert not connected_components(spark.createDataFrame([], "a long, b long")).collect()


def test_exact_groups(docs):
    rows = cases()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    got = exact_dedup.exact_groups(docs(rows), carry={"digest": F.sha2(exact_dedup.normalised(F.col("text")), 256)}).collect()
    assert len(got) == len(rows)
    by = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = by[r.digest]
        least = min((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (least, len(ids), r.doc_id == least)


def test_exact_query_equals_sql(spark):
    same(spark, queries.op9_exact_dedup, queries.oracle_sql()["op9_exact_dedup"], SMALL)


def test_drop_exact_copies_drops_repeated_rows(docs):
    out = exact_dedup.drop_exact_copies(docs([(2, "a  b"), (1, "a b"), (1, "a b"), (3, None), (4, ""), (None, "a b")]))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"]


@pytest.mark.parametrize("operator", [near_dedup.near_components, exact_dedup.exact_groups, suffix_dedup.find_repeats])
def test_empty_table(docs, operator):
    assert operator(docs([(1, "x")]).where("doc_id > 1")).count() == 0


def brute_repeats(rows):
    least, out = {}, {}
    data = {i: (t or "").encode() for i, t in rows if i is not None}
    for i in sorted(data, reverse=True):
        for p in range(len(data[i]) - 49):
            least[data[i][p : p + 50]] = i
    for i, b in data.items():
        covered = bytearray(len(b))
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < i:
                covered[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        out[i] = (len(b), sum(covered), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(kept).hexdigest())
    return out


def run_repeats(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return queries.op2_suffix_dedup(spark, str(tmp_path)).collect()


def test_repeated_strings(spark, tmp_path):
    shared = "A passage that stands in more than one document, with ñ and 漢字, " * 2
    rows = [(5, prose(1, 20) + shared + prose(2, 20)), (3, prose(3, 9) + shared), (9, shared + shared[:60] + prose(4, 3)), (1, None), (2, ""), (4, "short"), (6, "z" * 300), (7, "z" * 49), (8, "z" * 50), (10, "z" * 120 + "y" * 70), (11, shared), (12, shared), (13, "ab" * 200), (14, "ba" * 90 + "q"), (15, prose(1, 20)[5:] + "!"), (16, "z" * 300), (17, prose(8, 90_000)), (18, prose(8, 90_000)[400_000:] + "tail")]
    rows = [(i, t) for i, t in rows]
    want = brute_repeats(rows)
    got = run_repeats(spark, rows + [(None, shared)], tmp_path)
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


def snippets_of(texts):
    """(key, bytes, document) of every anchor of every text."""
    for i, text in enumerate(texts):
        at, h = suffix_dedup.anchors(np.frombuffer(text, np.uint8))
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(h[at[a]] >> np.uint64(24)), text[a : b + 49], i


@pytest.mark.parametrize("lane, long", [(100, 100), (700, 400), (4096, 4096), (10**9, 10**9)])
def test_anchors_with_many_surroundings(monkeypatch, lane, long):
    monkeypatch.setattr(suffix_dedup, "LANE_BYTES", lane)
    monkeypatch.setattr(suffix_sort, "LONG", long)
    middle = "the middle gram of all of them, and more that all of them have, aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"
    texts = [(f"left{k % 7}side{k % 5} " * 3 + middle + f" right{k % 4}end{k % 3}" * 3 + f" and then {k * 7919 % 1009} follows" * 2).encode() for k in range(60)]
    keys, parts, ids = zip(*snippets_of(texts), strict=True)
    flat, edge = suffix_dedup._label(np.array(keys, np.uint64), list(parts), np.array(ids), np.array(ids))
    got = np.split(flat, edge[1:-1])
    having = {}
    for k, part, i in zip(keys, parts, ids, strict=True):
        for w in range(len(part) - 49):
            having.setdefault((k, part[w : w + 50]), set()).add(i)
    for k, part, labels in zip(keys, parts, got, strict=True):
        want = [having[k, part[w : w + 50]] for w in range(len(part) - 49)]
        assert labels.tolist() == [min(h) if len(h) > 1 else suffix_dedup.NO_DOC for h in want]


def test_single_strings_meet_in_the_suffix_array():
    strings = [bytes([65 + k % 5]) * 50 for k in range(40)] + [b"b" * 49 + bytes([k]) for k in range(40)]
    keys = np.array([suffix_dedup.SINGLE | hash(s) % 3 for s in strings], np.uint64)
    got = suffix_dedup._label(keys, strings, np.arange(80), np.arange(80))[0]
    same_lane = {}
    for k, s in enumerate(strings):
        same_lane.setdefault(s, []).append(k)
    assert got.tolist() == [min(v) if len(v := same_lane[s]) > 1 else suffix_dedup.NO_DOC for s in strings]


@pytest.mark.parametrize("batches", [0, 1])
def test_hot_anchors_change_nothing(spark, monkeypatch, batches):
    docs = spark.read.parquet(f"{SMALLER}/documents.parquet").repartition(5)
    want = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    monkeypatch.setattr(suffix_dedup, "HOT_BATCHES", batches)
    found = suffix_dedup.find_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) for r in found} == {i: w[:3] for i, w in want.items()}


def test_repeats_on_small_table(spark):
    docs = spark.read.parquet(f"{SMALLER}/documents.parquet")
    want = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_dedup(spark, SMALLER).collect()}
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=12))
def test_suffix_arrays(strings):
    import numpy as np

    from sondeo.llm.suffix_sort import suffix_arrays

    strings = [[*s, 0] for s in strings]
    starts = np.cumsum([0] + [len(s) for s in strings])[:-1]
    usual = suffix_sort.LONG
    try:
        for suffix_sort.LONG in (usual, 5, 0):  # all together, some alone, all alone
            got = suffix_arrays(np.array([x for s in strings for x in s], np.int64), starts)
            for s, a in zip(strings, starts, strict=True):
                assert (got[a : a + len(s)] - a).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    finally:
        suffix_sort.LONG = usual


def test_packed_columns():
    rng = np.random.default_rng(3)
    for columns in ([[0]], [[5, -7, 2**62, -(2**62)], [2**63 - 1, -(2**63), 0, 1]], rng.integers(-(2**63), 2**63 - 1, (5, 700)).tolist()):
        own = [np.array(c, np.int64) for c in columns]
        assert suffix_dedup._unpacked(suffix_dedup._packed(*own), len(own)).tolist() == [c.tolist() for c in own]
    ids = np.arange(10**6, 10**6 + 1000)
    assert len(suffix_dedup._packed(ids, ids, ids // 9)) < 1000


def test_documents_give_their_snippets_in_turns(spark, tmp_path, monkeypatch):
    """Same result; a turn moves its own texts only, and snippets lie packed."""
    monkeypatch.setattr(suffix_dedup, "ONE_TURN_BYTES", 0)
    written = {}
    materialize = suffix_dedup.materialize

    def measured(df, label):
        out = materialize(df, label)
        if label == "snippets":
            written.setdefault(label, []).append((out.where("kind = 1").count(), out.agg(F.sum(F.octet_length("texts") + F.octet_length("keys"))).head()[0] or 0))
        return out

    monkeypatch.setattr(suffix_dedup, "materialize", measured)
    passages = [prose(100 + i, 60) for i in range(12)]
    rows = [(i, prose(i, 20) + passages[i % 12] + prose(500 + i, 20) + passages[i * 5 % 12][:200]) for i in range(240)]
    want = brute_repeats(rows)
    for r in run_repeats(spark, rows, tmp_path):
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert len(written["snippets"]) == suffix_dedup.TURNS and all(n > 0 for n, _ in written["snippets"])
    assert sum(size for _, size in written["snippets"]) < sum(len(t.encode()) for _, t in rows)
