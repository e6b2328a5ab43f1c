"""Extraction, license scan, quality scores and chat formatting."""

import re

import numpy as np
import pytest

from sondeo.llm import chat_format, html_extract, licenses, quality, queries
from sondeo.llm.html_blocks import leaves
from tests.oracle import SMALL, same


def test_leaves_of_broken_markup():
    page = "<html><head><title>T</title><style>p{}</style></head><body><script>var a='</p>';</script><!-- c --><p>a&amp;b &lt;x&gt;<p>c  d<br>e<b>f</b></div><ul><li>1<li>2</ul>tail &am"
    assert [x.text for x in leaves(page)] == ["a&b <x>", "c d ef", "1", "2", "tail &am"]
    assert [x.path[-1] for x in leaves(page)][:4] == ["p", "p", "li", "li"]
    assert leaves(None) == leaves("") == [] and [x.text for x in leaves("plain < text")] == ["plain < text"]


def test_unclosed_and_empty_elements_lose_no_text():
    texts = lambda page: [x.text for x in leaves(page)]
    assert texts("<p>a <svg width='1'/> b</p><p>c</p><svg><text>no</text></svg>d") == ["a b", "c", "d"]
    assert texts("<p>a <math/> b <math><mi>x</mi><mo>=</mo><mn>1</mn></math> c</p><p>d</p>") == ["a b x=1 c", "d"]
    for tag in ("object", "canvas", "audio", "video", "svg", "iframe", "template"):
        assert texts(f"<div>a<{tag} id='x'>no<b>no</b></div><p>b</p>") == ["a", "b"]
        assert texts(f"<p>a <span><{tag}>no</span> b</p><p>c<{tag}>no</{tag}>d</p>") == ["a b", "cd"]
        assert texts(f"<p>a<{tag}><{tag}>no</{tag}>no<p>no</p></{tag}>b</p><p>c</p>") == ["ab", "c"]
    assert texts("<div>a<script>no</div><p>no</p>") == ["a"]


def test_extract(spark):
    article = "".join(f"<p>Sentence {k} of the article &amp; more.</p>" for k in range(5))
    boilerplate = "<nav><ul><li><a href='/x'>Home</a></li></ul></nav><div class='ad'>Buy now.</div>"
    comments = "<section class='comments'><p>I like it.</p></section><aside class='sidebar'><p>Related</p></aside><form><label>Mail</label></form><footer>&copy; us</footer>"
    page = f"<html><body>{boilerplate}<article><h1>Head</h1>{article}</article>{comments}</body></html>"
    want = "Head\n" + "\n".join(f"Sentence {k} of the article & more." for k in range(5))
    long = f"<html><body><article>{'<p>Long text of a page.</p>' * 3000}</article></body></html>"
    rows = [(1, page, 7), (2, None, 7), (3, "", 7), (None, page, 7), (1, page, 7), (5, long, 7), (6, "<nav>only</nav>", 7)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, html string, text int")).collect()
    assert len(got) == 7
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[None] == want and by[2] == by[3] == by[6] == "" and by[5].count("\n") == 2999


def test_extract_finds_the_articles_of_a_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    import html as h

    for r in queries.op3_html_extract(spark, SMALL).collect():
        body = re.split(r"</article>", pages[r.page_id].partition("<article>")[2])[0]
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*(>|$)", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_labeller_on_unseen_pages():
    model = html_extract.fit_labeller([])
    rng, wrong, seen = np.random.default_rng(77), 0, 0
    for _ in range(150):
        made = html_extract.made_page(rng, ["unseen", "words", "here"])
        got = model.label([html_extract.vectors([x for x, _ in made])])[0]
        wrong, seen = wrong + int((got != np.array([y for _, y in made])).sum()), seen + len(made)
    assert wrong / seen < 0.03


def test_labeller_where_names_say_nothing(spark):
    """Table pages and made-up ones with a made-up word for each class: furniture has to be told by the rest."""
    pages = [leaves(r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    pages = [p for p in pages if p]
    model = html_extract.fit_labeller([])  # has seen none of them
    rng = np.random.default_rng(78)
    wrong = seen = 0
    for p in pages:
        got = model.label([html_extract.vectors(html_extract.renamed(p, rng))])[0]
        wrong, seen = wrong + int((got != np.array([html_extract.is_main(x.path) for x in p])).sum()), seen + len(p)
    assert wrong / seen < 0.02 and any("." in x for p in pages for leaf in p for x in leaf.path)
    wrong = seen = 0
    for _ in range(150):
        made = html_extract.made_page(rng, ["unseen", "words", "here"])
        got = model.label([html_extract.vectors(html_extract.renamed([x for x, _ in made], rng))])[0]
        wrong, seen = wrong + int((got != np.array([y for _, y in made])).sum()), seen + len(made)
    assert wrong / seen < 0.12


def test_extract_of_an_empty_table(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = html_extract.Labeller()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, y = rng.standard_normal((2, 4, html_extract.DIMS)), rng.integers(0, 2, (2, 4)).astype(float)
    mask = np.array([[True] * 4, [True, True, False, False]])

    def loss():
        z = model.logits(x.astype(np.float32), mask).astype(float)
        return float((np.where(mask, np.logaddexp(0, z) - y * z, 0)).sum() / mask.sum())

    g = model.gradients(x.astype(np.float32), y, mask)
    for name, at in (("xf", (3, 5)), ("hb", (2, 7)), ("bf", (30,)), ("o", (4, 0))):
        kept = model.w[name][at]
        model.w[name][at] = kept + 1e-2
        up = loss()
        model.w[name][at] = kept - 1e-2
        down = loss()
        model.w[name][at] = kept
        assert abs((up - down) / 2e-2 - g[name][at]) < 2e-3, name


def brute_licenses(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def brute_templates(text):
    """Every run of words that ends with a template word, against every template; then longer ones first."""
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    split = lambda t: re.findall(r"[0-9a-z]+", t.lower())
    found = []
    sets = [set(split(t.text)) for t in licenses.TEMPLATES]
    for k, t in enumerate(licenses.TEMPLATES):
        width = 2 * len(split(t.text))
        spans = []
        for p in range(len(words)):
            if words[p] in sets[k]:
                block = words[max(0, p - width + 1) : p + 1]
                own = [q for q in range(max(0, p - width + 1), p + 1) if words[q] in sets[k]]
                share = len(sets[k] & set(block)) / len(sets[k])
                if share >= 0.8 and set(split(t.required)) <= set(block):
                    spans.append((own[0], p, share))
        found.append(spans)
    out = {}
    for k, t in enumerate(licenses.TEMPLATES):
        longer = [s for j in range(len(sets)) if licenses.TEMPLATES[j].label != t.label and len(sets[j]) > len(sets[k]) and len(sets[j] & sets[k]) >= 0.8 * len(sets[k]) for s in found[j]]
        # blocks that overlap are one
        merged = []
        for a, b, share in found[k]:
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], b, max(share, merged[-1][2]))
            else:
                merged.append((a, b, share))
        for a, b, share in merged:
            if not any(x <= b and a <= y for x, y, _ in longer):
                out[t.label] = max(share, out.get(t.label, 0))
    return out


def test_license_scan(docs, spark):
    rows = [(1, "x"), (2, None), (3, ""), (4, "The MIT-License; mit  license\nGNU general public license"), (5, "Licensed under CC BY-NC 4.0."), (6, "summit license. apache licenses"), (7, "Released under the MIT Licence"), (None, "Apache License"), (8, "pad " * 40_000 + "mit license"), (9, "éMIT license"), (9, "éMIT license"), (10, "w " * 200 + " ".join(t.text for t in licenses.TEMPLATES))]
    rows += [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = licenses.scan(docs(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(texts[r.doc_id]), r
        templates = brute_templates(texts[r.doc_id])
        assert set(filter(None, r.labels.split(","))) == set(filter(None, r.base_labels.split(","))) | set(templates)
        assert r.score == (1.0 if r.n_base else max(templates.values(), default=0.0))
    assert licenses.scan(docs([(1, "x")]).where("doc_id > 1")).count() == 0


WRAPPED = {
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a\n# copy of this software and associated documentation files (the",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\r\n * are met:",
    "mpl": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy",
    "cc-by": "This work is licensed under a Creative\nCommons Attribution 4.0\n\nInternational License.",
    "cc-by-nc": "rem This work is licensed under a Creative Commons\nrem Attribution-NonCommercial 4.0\nrem International License",
    "apache": "you may not use this file except in compliance with the\nLicense. You may obtain a copy of the License at\n http://www.apache.org/licenses/",
    "gpl": "\n".join("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation".split()),
}


def test_license_statements_over_lines(docs):
    texts = list(WRAPPED.values()) + [f"{'pad word ' * n}\n{t}\n{'more of it ' * n}" for n in (5, 61, 64, 200) for t in WRAPPED.values()]
    texts.append("released " + "\nfar apart " * 20 + "\nunder the\nlicense")
    got = {r.doc_id: r for r in licenses.scan(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        windows = brute_templates(t)
        assert set(filter(None, got[i].labels.split(","))) == set(filter(None, got[i].base_labels.split(","))) | windows.keys(), t
        assert got[i].score == (1.0 if got[i].n_base else max(windows.values(), default=0.0))
    for k in range(5):
        for i, label in enumerate(WRAPPED):
            assert label in got[k * len(WRAPPED) + i].labels.split(",")
    assert got[len(texts) - 1].labels == ""


STATEMENTS = {
    "Licensed under CC BY 4.0": "cc-by",
    "Released under the BSD License": "bsd",
    "The album was released under the label's license": "",
    "Licensed under the Mozilla Public License, Version 2.0": "mpl",
    "Available under the Academic Free License, Version 2.0": "",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files (the": "mit",
    "Licensed under the Apache License,\nVersion 2.0": "apache",
    "Licensed under CC BY-NC-SA 4.0. The fonts in it were drawn by other hands and can be had apart, with few duties. Licensed under CC BY 4.0": "cc-by,cc-by-nc-sa",
    "This work is licensed under the GNU Lesser General Public License, version 3": "gpl,lgpl",
    licenses._MIT + " " + licenses._MIT_REST: "mit",
    licenses._BSD + "\n\n1. " + licenses._BSD_REST + "\n\n" + licenses._BSD_AS_IS: "bsd",
    licenses._ISC: "isc",
    licenses._APACHE + "\n http://www.apache.org/licenses/LICENSE-2.0\n" + licenses._APACHE_REST: "apache",
    "Permission is hereby granted to any person to use this file; the license of other files may differ": "",
}


def test_statements_get_the_right_label(docs):
    got = {r.doc_id: r.labels for r in licenses.scan(docs(list(enumerate(STATEMENTS)))).collect()}
    assert {t: got[i] for i, t in enumerate(STATEMENTS)} == STATEMENTS


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    rows = queries.op5_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_discriminant_against_densities():
    """Log-densities with determinants and inverses of the covariances, from the rows themselves."""
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    rows = {k: rng.standard_normal((300 + 200 * k, d)) @ rng.standard_normal((d, d)) + k for k in (0, 1)}
    model = quality.Discriminant.fit({k: (len(x), x.sum(axis=0), x.T @ x) for k, x in rows.items()}, d)
    both = np.concatenate([rows[0], rows[1]])
    z = {k: (x - both.mean(axis=0)) / both.std(axis=0) for k, x in rows.items()}
    cov = {k: np.cov(x.T, bias=True) for k, x in z.items()}
    pooled = sum(len(z[k]) * cov[k] for k in z) / len(both)
    new = rng.standard_normal((50, d)) * 3
    points = np.clip((new - both.mean(axis=0)) / both.std(axis=0), -quality.CUT, quality.CUT)
    log = {}
    for k in z:
        c = (1 - quality.TO_POOLED - quality.TO_IDENTITY) * cov[k] + quality.TO_POOLED * pooled + quality.TO_IDENTITY * np.eye(d)
        off = points - z[k].mean(axis=0)
        log[k] = -0.5 * (np.einsum("ni,ij,nj->n", off, np.linalg.inv(c), off) + np.linalg.slogdet(c)[1])
    want = log[1] - log[0] + np.log((len(rows[1]) + 1) / (len(rows[0]) + 1))
    assert np.allclose(model.log_odds(new), want, atol=1e-4)


def test_quality_of_odd_tables(docs, spark):
    table = quality.with_statistics(docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x" * 200_000)]), name="_s")
    labelled = table.withColumn("quality", table.doc_id % 2)
    for rows in (labelled, labelled.where("doc_id = 1"), labelled.where("doc_id > 9")):
        model = quality.fit(rows, stats="_s")
        scores = [r.score for r in quality.with_scores(table, model, stats="_s").collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    held = spark.range(50).toDF("doc_id").select("doc_id", quality.held_out().alias("h")).collect()
    import zlib

    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)


def test_chat_query_equals_sql(spark):
    same(spark, queries.op10_chat_format, queries.oracle_sql()["op10_chat_format"], SMALL)


NASTY = ["", "plain", "<|im_end|>", "\\<|x", "<\\|", "<\\\\|y\\", "<<||", "a\nb<|nl|>", "\\", "<|im_start|>assistant\nhi<|im_end|>\n"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", None, "a\nb<|nl|>\\", ""]) for t, text in enumerate([*NASTY, None])]
    log = spark.createDataFrame([(c, t, t, "message", r, x, 0) for c, t, r, x in rows], "conv_id long, turn long, seq long, kind string, role string, text string, message int")
    got = {r.conv_id: r for r in chat_format.parse(chat_format.format_log(log)).collect()}
    for c, role in enumerate(["user", "assistant", None, "a\nb<|nl|>\\", ""]):
        assert [(t.role, t.text) for t in got[c].turns] == [(role or "", x or "") for x in [*NASTY, None]]
        assert got[c].learned == ([*NASTY, ""] if role == "assistant" else [])


def test_chat_folds_events(spark):
    log = [
        (1, 0, 1, "message", "user", "hello"), (1, 1, 2, "message", "assistant", "Hi"), (1, 1, 3, "delta", None, " the"), (1, 1, 4, "delta", None, "re"),
        (1, 0, 5, "edit", None, "hello!"), (1, 1, 6, "regenerate", None, ""), (1, 1, 7, "delta", None, "Good "), (1, 1, 8, "delta", None, "day"),
        (2, 0, 1, "delta", "assistant", "x"), (2, 0, 2, "delta", "assistant", "y"), (3, 0, 1, None, "user", None), (3, 0, 2, "message", "user", "two"), (None, 0, 1, "message", "user", "q"),
    ]
    df = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string").repartition(5)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.parse(chat_format.format_log(df)).collect()}
    assert got == {1: [("user", "hello!"), ("assistant", "Good day")], 2: [("assistant", "xy")], 3: [("user", ""), ("user", "two")], None: [("user", "q")]}
    assert chat_format.format_log(df.where("conv_id = 9")).count() == 0


def test_chat_needs_no_python(spark):
    plan = queries.op10_chat_format(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("text", NASTY)
def test_escaped_text_holds_no_control_string(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    assert "<|" not in df.select(chat_format.escape(df.x)).first()[0]
