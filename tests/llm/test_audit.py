"""Source divergence audit."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondeo.llm import divergence, queries
from tests.oracle import same


def audited(rows, least, shown):
    """Term by term, over all kept terms of each pair of groups."""
    groups, by_lang, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups[lang, source].update(found)
        by_lang[lang].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def prices(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        own, whole = prices(groups[lang, source]), prices(by_lang[lang])
        pair = [(b, sum(abs(own[t] - x) for t, x in prices(groups[a, b]).items())) for a, b in groups if a == lang and b != source]
        term = [(t, own[t] - whole[t]) for t in kept if groups[lang, source][t] and own[t] > whole[t]]
        for part, found, most in (("pair", pair, None), ("term", term, shown)):
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most])]
    return sorted(out)


def made(n, sources=6, seed=3):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "ñandú", "ÑANDÚ", "x1y", "漢字", "it's"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for _ in range(n):
        source = int(min(rng.geometric(0.4), sources))
        picked = rng.choice(words, int(rng.integers(0, 25)), p=np.roll(weights, 3 * source) / weights.sum())
        rows.append((["en", "de"][source % 2 and int(rng.integers(2))], f"s{source}", " ".join(picked)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "lang string, source string, text string, n int, term string, at double").repartition(3)


EDGES = [(None, None, None), (None, "a", ""), ("", "a", "the the"), ("xx", "only", "word " * 50), ("en", "", "the é"), ("en", "words none", "1 2 3"), ("yy", "b", None), ("yy", "c", "!"), ("yy", "é", "one")] + [("en", "hot", "the the the it")] * 60


@pytest.mark.parametrize("least, shown", [(1, 50), (5, 4), (30, 2)])
def test_against_sums_over_all_terms(spark, monkeypatch, least, shown):
    rows = made(200) + EDGES
    want = audited(rows, least, shown)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows), least=least, shown=shown).collect())) == want
    for name in ("HELD", "HELD_PAIRS", "CELLS"):  # small enough that tasks send on what they hold
        monkeypatch.setattr(divergence, name, 7)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows), least=least, shown=shown).collect())) == want


def test_many_sources_and_one_long_text(spark):
    rows = [("en", f"s{i}", f"w{chr(97 + i % 7)} common only{'abcdefghij'[i % 10]}") for i in range(90)] + [("en", "long", "common " * 300_000 + "rare")]
    assert sorted(map(tuple, divergence.audit(frame(spark, rows), least=2).collect())) == audited(rows, 2, 50)


def test_nothing_kept_and_nothing_there(spark):
    rows = [("en", "a", "one"), ("en", "b", "two"), ("en", "c", None)]
    got = sorted(map(tuple, divergence.audit(frame(spark, rows)).collect()))
    assert got == audited(rows, 30, 50) and all(r[4] == 0 for r in got) and len(got) == 6
    assert divergence.audit(frame(spark, rows).where("lang = 'no'")).count() == 0


def test_prices_are_exact(spark):
    counts = [(0, 0, 1), (0, 10, 3), (7, 7, 1), (10**14, 10**14 + 3, 10**9), (123456789012345, 987654321012345, 7), (0, 10**15, 10**8)]
    df = spark.createDataFrame(counts, "c long, n long, v long")
    assert [r.p for r in df.select(divergence.price("c", "n", "v").alias("p")).collect()] == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in counts]
    assert spark.range(1).select(divergence.price("0L", "0L", "0L").alias("p")).head().p is None


def test_query_equals_sql(spark):
    same(spark, queries.queries()["op12_divergence"], queries.oracle_sql()["op12_divergence"], "/root/testdata/sf0.01")


def test_no_pairs_of_a_term_leave_a_task(spark):
    """Of 200 sources that all have the same 50 terms a task sends sums by pair, not pairs by term."""
    rows = [("en", f"s{i:03}", " ".join(f"w{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(50))) for i in range(200)]
    found = divergence.audit(frame(spark, rows), least=1)
    assert found.where("part = 'pair'").agg(F.count("*"), F.sum("value")).head() == (200 * 199, 0)
