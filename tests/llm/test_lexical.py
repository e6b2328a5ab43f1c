"""Ranked lexical search."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from sondeo.llm import lexical, queries
from tests.llm.conftest import prose
from tests.oracle import same


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def ranked(docs, items, k=10):
    """Every document for every item."""
    counted = [(i, terms_of(t)) for i, t in docs]
    n_docs, n_all = sum(bool(w) for _, w in counted), sum(len(w) for _, w in counted)
    df = Counter(t for _, w in counted for t in set(w))
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, w in counted:
            tf = Counter(w)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * (100 - 90 + 90 * len(w) * n_docs // n_all))) for t in wanted if tf[t])
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, n + 1, f[3], -f[0]) for n, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def made(n, seed=5):
    rng = np.random.default_rng(seed)
    words = ["The", "ñandú", "漢字", "x1", "2", "it's"] + [f"w{i}" for i in range(80)]
    weights = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, int(rng.integers(0, 30)), p=weights / weights.sum())) for _ in range(n)]


def found(docs, items, spark, rows, k=10):
    queries_ = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc string, score int")
    got = map(tuple, lexical.search(docs(rows), queries_, k).collect())
    return sorted(got, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


ITEMS = [(1, "the w1 w2 w3 w3"), (2, "ñandú W70"), (3, None), (4, ""), (5, "nowhere"), (None, "x1 2"), (6, "w5"), (6, "w60 w61 nowhere")] + [(100 + i, t) for i, t in enumerate(made(12, 9))]


@pytest.mark.parametrize("small", [False, True])
def test_against_every_document(spark, docs, monkeypatch, small):
    texts = made(150)
    rows = list(enumerate(texts)) + [(1000 + i, texts[7]) for i in range(40)] + [(None, texts[8]), (3, texts[9]), (3, texts[9]), (2000, None), (2001, ""), (2002, "!?"), (2003, prose(1, 4000) + " w1 w5" * 2000), (-4, "w60 w61")]
    if small:  # many shards, one interval at a time, small ones first, few queries together
        for name, n in (("SHARD_DOCS", 9), ("SHARD_POSTINGS", 60), ("SPLIT", 1), ("WAITING_CELLS", 0), ("ASKED_CELLS", 8), ("QUERY_BYTES", 300)):
            monkeypatch.setattr(lexical, name, n)
    assert found(docs, ITEMS, spark, rows) == ranked(rows, ITEMS)
    assert found(docs, ITEMS, spark, rows, 3) == ranked(rows, ITEMS, 3)


def test_nothing_to_find(spark, docs):
    rows = [(1, "one"), (2, None)]
    assert found(docs, [(3, None), (4, "two")], spark, rows) == []
    assert found(docs, ITEMS[:1], spark, []) == [] and found(docs, [], spark, rows) == []
    assert found(docs, [(1, "one one")], spark, [(1, "one")]) == ranked([(1, "one")], [(1, "one one")])


def depth(treaps, node):
    deepest, open_ = 0, [(node, 1)]
    while open_:
        i, n = open_.pop()
        deepest = max(deepest, n)
        open_ += [(int(c), n + 1) for c in (treaps.left[i], treaps.right[i]) if c >= 0]
    return deepest


def index(n_docs, n_terms, impact, seed=1):
    rng = np.random.default_rng(seed)
    pairs = np.unique(rng.integers(0, n_terms, 6 * n_docs) * n_docs + rng.integers(0, n_docs, 6 * n_docs))
    shuffled = rng.permutation(pairs)
    return lexical.Treaps(shuffled // n_docs, shuffled % n_docs, impact(rng, len(pairs)), n_terms)


def test_treaps_are_in_search_and_heap_order():
    treaps = index(300, 11, lambda rng, n: rng.integers(1, 50, n))
    for t, root in enumerate(treaps.root.tolist()):
        own = np.flatnonzero(treaps.term == t)
        seen, open_ = [], [(root, -1, 10**9)]
        while open_:
            i, low, high = open_.pop()
            seen.append(i)
            assert low < treaps.doc[i] < high
            for child, a, b in ((treaps.left[i], low, treaps.doc[i]), (treaps.right[i], treaps.doc[i], high)):
                if child >= 0:
                    assert treaps.impact[child] <= treaps.impact[i]
                    open_.append((int(child), a, b))
        assert sorted(seen) == own.tolist()
    equal = index(20_000, 1, lambda rng, n: np.full(n, 7))
    assert depth(equal, int(equal.root[0])) < 80


def test_subtrees_are_pruned():
    """Of 20,000 documents with a common term only those with the rare ones are scored, and few others."""
    n, rare = 20_000, 25
    rng = np.random.default_rng(2)
    with_rare = rng.choice(n, rare, replace=False)
    term = np.concatenate([np.zeros(n, np.int64), np.ones(rare, np.int64)])
    doc = np.concatenate([np.arange(n), with_rare])
    treaps = lexical.Treaps(term, doc, rng.integers(1000, 9000, n + rare), 2)
    best = lexical.Best(1, 10)
    scored = lexical.ask(treaps, np.arange(n), np.array([0]), np.array([[0, 1]]), np.array([[300, 9000]]), best)
    all_scores = np.zeros(n, np.int64)
    np.add.at(all_scores, treaps.doc, np.where(treaps.term == 0, 300, 9000) * treaps.impact)
    want = sorted(zip(-all_scores, range(n), strict=True))[:10]
    assert [(-s, d) for s, d in zip(best.score.tolist(), best.doc.tolist(), strict=True)] == want and scored < 200


def test_query_equals_sql(spark):
    same(spark, queries.queries()["op13_lexical_search"], queries.oracle_sql()["op13_lexical_search"], "/root/testdata/sf0.01")
