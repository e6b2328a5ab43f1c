"""License scan: base phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from collections import Counter, deque
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Phrases and their labels. Fixed values of the contract.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


class Template(NamedTuple):
    """required: words that tell it from its likes; a block without them is no match, however many others it holds."""

    label: str
    required: str
    text: str


#: Creative Commons licenses: what follows BY in the short name, and Attribution in the long one.
_COMMONS = {"": "", "SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial", "NC-SA": "NonCommercial-ShareAlike", "NC-ND": "NonCommercial-NoDerivatives"}
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the
Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"""
_BSD_REST = """Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"""
_APACHE_REST = """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version."""
_GNU_AS_IS = """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
PURPOSE. See the GNU {0} for more details."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
#: Licenses by label: a word that names each, and its name, as short statements give it.
_NAMES = (
    ("mit", "mit", "MIT License"),
    ("bsd", "bsd", "BSD License"),
    ("isc", "isc", "ISC License"),
    ("apache", "apache", "Apache License, Version 2.0"),
    ("mpl", "mozilla", "Mozilla Public License, Version 2.0"),
    ("gpl", "gnu general public", "GNU General Public License, version 3"),
    ("lgpl", "lesser general public", "GNU Lesser General Public License, version 3"),
    ("agpl", "affero general public", "GNU Affero General Public License, version 3"),
)
_GNU_NAMES = (("gpl", "general public", "General Public License"), ("lgpl", "lesser public", "Lesser General Public License"), ("agpl", "affero public", "Affero General Public License"))

#: Bodies, notices and statements of licenses.
TEMPLATES = (
    Template("mit", "permission obtaining", _MIT[: _MIT.index("(the")]),  # often quoted alone
    Template("mit", "permission sublicense", _MIT),
    Template("mit", "noninfringement", _MIT_REST),
    Template("mit", "permission noninfringement", f"{_MIT} {_MIT_REST}"),
    Template("bsd", "redistribution", _BSD),
    Template("bsd", "redistributions", _BSD_REST),
    Template("bsd", "contributors", _BSD_AS_IS),
    Template("bsd", "redistributions contributors", f"{_BSD} {_BSD_REST} {_BSD_AS_IS}"),
    Template("isc", "permission fee", _ISC),
    Template("apache", "compliance obtain", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http www apache org licenses"),
    Template("apache", "apache", _APACHE),
    Template("apache", "apache governing", f"{_APACHE} http://www.apache.org/licenses/LICENSE-2.0 {_APACHE_REST}"),
    *(Template(label, f"gnu {need} redistribute", _GNU.format(name)) for label, need, name in _GNU_NAMES),
    *(Template(label, f"gnu {need} warranty redistribute", f"{_GNU} {_GNU_AS_IS}".format(name)) for label, need, name in _GNU_NAMES),
    Template("gpl", "gnu general public redistribute", _GNU.format("General Public License")[: _GNU.format("General Public License").index(", either")]),
    Template("mpl", "mozilla", _MPL),
    Template("unlicense", "unencumbered", _UNLICENSE),
    *(Template(label, need, f"{start} {name}") for label, need, name in _NAMES for start in ("Released under the", "Licensed under the", "This work is licensed under the")),
    *(Template(f"cc-by{'-' * bool(k)}{k.lower()}", " ".join(["cc by", *k.lower().split("-")]), f"Licensed under CC BY{'-' * bool(k)}{k} 4.0") for k in _COMMONS),
    *(Template(f"cc-by{'-' * bool(k)}{k.lower()}", " ".join(["commons attribution", *x.lower().split("-")]), f"This work is licensed under a Creative Commons Attribution{'-' * bool(x)}{x} 4.0 International License") for k, x in _COMMONS.items()),
)
#: Share of a template's different words that a block must hold.
CONTAINMENT = Fraction(4, 5)
#: Words of a block for each word of the template: a statement may have line wraps, comment marks or other words between. Lines don't matter.
SPREAD = 2

#: Letters in lower case, digits and all bytes of other scripts stand for themselves; the rest parts words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def words_of(text: str | None) -> list[bytes]:
    return encoded(text).translate(_WORD_BYTES).split()


def template_words() -> list[list[bytes]]:
    return [words_of(t.text) for t in TEMPLATES]


def covering() -> list[frozenset[int]]:
    """Of each template those of other labels that are longer and hold it to the threshold: where such a one matches too, it is the one that is meant."""
    sets = [set(w) for w in template_words()]
    return [frozenset(j for j, y in enumerate(sets) if TEMPLATES[j].label != TEMPLATES[i].label and len(y) > len(x) and len(x & y) >= CONTAINMENT * len(x)) for i, x in enumerate(sets)]


def word_counts(docs: DataFrame, text_col: str = "text") -> dict[bytes, int]:
    """How often each template word stands in all documents; one row per template word reaches the driver."""
    vocabulary = sorted(set().union(*template_words()))
    at = {w: i for i, w in enumerate(vocabulary)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(at), np.int64)
        for pdf in batches:
            for text in pdf["t"]:
                for w, n in Counter(filter(at.__contains__, words_of(text))).items():
                    total[at[w]] += n
        yield pd.DataFrame({"word": np.arange(len(at), dtype=np.int32), "n": total})

    sums = docs.select(F.col(text_col).alias("t")).mapInPandas(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {vocabulary[r["word"]]: r["n"] for r in sums} or dict.fromkeys(vocabulary, 0)


class Join:
    """Templates with their words in one order, rarest first, and the index of their prefixes."""

    def __init__(self, counts: dict[bytes, int]):
        self.order = {w: i for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}
        self.templates = [sorted({self.order[w] for w in words}) for words in template_words()]
        self.least = [math.ceil(CONTAINMENT * len(t)) for t in self.templates]
        self.required = [frozenset(self.order[w] for w in words_of(t.required)) for t in TEMPLATES]
        self.widths = [SPREAD * len(words) for words in template_words()]
        self.covering = covering()
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.templates):
            for i, w in enumerate(words[: len(words) - self.least[k] + 1]):
                self.prefixes.setdefault(w, []).append((k, i))
        by_place = {i: w for w, i in self.order.items()}
        self.prefix_words = frozenset(by_place[i] for i in self.prefixes)

    def held(self, text: list[bytes]) -> Iterator[int]:
        """All templates that the text as a whole holds to the threshold: only they can be held by a block of it."""
        known = {self.order[w] for w in set(text) if w in self.order}
        own = sorted(known)
        tried: set[int] = set()
        for j, w in enumerate(own):
            for k, i in self.prefixes.get(w, ()):
                words, least = self.templates[k], self.least[k]
                if k in tried or len(own) < least:  # length filter
                    continue
                tried.add(k)
                # positional filter: w is the first common word, so the rest lies behind it in both
                if min(len(words) - i, len(own) - j) < least or not self.required[k] <= known:
                    continue
                if sum(1 for x in words if x in known) >= least:
                    yield k

    def blocks(self, k: int, places: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
        """Blocks that hold template k, as first and last word and containment; those that overlap are one.

        places: (place, word) of the text's template words. A block is a run of SPREAD times the template's number of
        words that ends with one of its words.
        """
        words, known = self.templates[k], set(self.templates[k])
        inside: deque[tuple[int, int]] = deque()
        count = dict.fromkeys(words, 0)
        different, missing = 0, len(self.required[k])
        out: list[tuple[int, int, float]] = []
        for p, w in places:
            if w not in known:
                continue
            inside.append((p, w))
            if not count[w]:
                different += 1
                missing -= w in self.required[k]
            count[w] += 1
            while inside[0][0] <= p - self.widths[k]:
                gone = inside.popleft()[1]
                count[gone] -= 1
                if not count[gone]:
                    different -= 1
                    missing += gone in self.required[k]
            if different >= self.least[k] and not missing:
                first, share = inside[0][0], different / len(words)
                if out and first <= out[-1][1]:
                    out[-1] = (out[-1][0], p, max(share, out[-1][2]))
                else:
                    out.append((first, p, share))
        return out

    def matches(self, text: list[bytes]) -> Iterator[tuple[str, float]]:
        """Labels and containments of the templates that blocks of the text hold, but where a longer one that covers them does."""
        if self.prefix_words.isdisjoint(text):
            return
        held = sorted(self.held(text))
        if not held:
            return
        places = [(p, self.order[w]) for p, w in enumerate(text) if w in self.order]
        found = {k: self.blocks(k, places) for k in held}
        for k in held:
            longer = [(a, b) for j in self.covering[k] for a, b, _ in found.get(j, ())]
            for first, last, share in found[k]:
                if not any(a <= last and first <= b for a, b in longer):
                    yield TEMPLATES[k].label, share


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are ordered by their number in all documents. A block, a run of words at most SPREAD times as long as a
    template, matches if it holds CONTAINMENT of the template's different words and all of its required ones; where a
    longer template that covers it matches in words that overlap, that one counts (statements less than a block apart are
    one). Prefixes, lengths and positions only spare comparisons
    that can't match. score is the largest containment of a match, 1 for a base phrase, 0 without either. Null and empty
    texts have no words: counts 0, places null, labels "". Every row is scanned whole and alone, so neither ties nor
    repeated rows matter; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    join = Join(word_counts(docs, text_col))
    phrases = [(b" " + p.encode() + b" ", label) for p, label in PHRASES.items()]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())])

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, text in zip(pdf["id"], pdf["t"], strict=True):
                words = words_of(text)
                places: list[int] = []
                base, more, score = set(), set(), 0.0
                for label, contained in join.matches(words):
                    more.add(label)
                    score = max(score, contained)
                flat = b" ".join([b"", *words, b""])
                for phrase, label in phrases:
                    at, before, place = flat.find(phrase), 0, 0
                    while at >= 0:
                        place += flat.count(b" ", before, at)
                        before = at
                        places.append(place)
                        base.add(label)
                        score = 1.0
                        at = flat.find(phrase, at + 1)
                out.append((key, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), score))
            frame = pd.DataFrame(out, columns=schema.names)
            yield frame.astype({"first_word": "Int64", "last_word": "Int64", "id": pdf["id"].dtype})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInPandas(look, schema).withColumnRenamed("id", id_col)
