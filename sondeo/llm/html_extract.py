"""Main text of HTML pages: a bidirectional LSTM labels every leaf block in the context of its page."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, in_one_task, small_batches
from .html_blocks import Leaf, leaves

PATH_DIMS, WORD_DIMS, OTHER_DIMS, HIDDEN = 96, 24, 6, 20
DIMS = PATH_DIMS + WORD_DIMS + OTHER_DIMS
#: Pages of the table, and made-up pages, that the labeller learns from; both are bounds, whatever the size of the table.
FIT_PAGES, MADE_PAGES = 200, 900
#: Share of them whose class names and ids are replaced by made-up words.
NAMELESS = 0.4

#: Elements and name parts that tell a page's furniture from its article.
FURNITURE_TAGS = frozenset("nav header footer aside form button label menu dialog fieldset legend".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert advertisement advertising banner sponsored sponsor promo promotion cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login search "
    "nav navigation navbar menu breadcrumb breadcrumbs sidebar side rail widget related recommended trending popular share sharing social follow tags "
    "footer header masthead toolbar pagination pager comment comments commentlist disqus reply replies discussion respond copyright legal disclaimer".split()
)


def is_main(path: tuple[str, ...]) -> bool:
    """What a path alone says: no furniture on it. The labeller learns from this; it decides by itself."""
    tags = {x for x in path if x[0] != "."}
    names = {x[1:] for x in path if x[0] == "."}
    inside = [i for i, x in enumerate(path) if x in ("article", "main")]
    own = path[inside[-1] :] if inside else path
    tags = {x for x in own if x[0] != "."} if inside else tags
    return not (tags & (FURNITURE_TAGS - ({"header"} if inside else set()))) and not (names & FURNITURE_NAMES)


def vectors(page: list[Leaf]) -> np.ndarray:
    """A row per leaf: hashed parts of its tag path (the last three once more), hashed words, length, links, marks and place."""
    out = np.zeros((len(page), DIMS), np.float32)
    for i, leaf in enumerate(page):
        row = out[i]
        for x in set(leaf.path):
            row[zlib.crc32(x.encode()) % PATH_DIMS] += 1
        for x in leaf.path[-3:]:
            row[zlib.crc32(b"last " + x.encode()) % PATH_DIMS] += 0.5
        words = leaf.text.split()
        for w in words:
            row[PATH_DIMS + zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_DIMS] += 1
        row[PATH_DIMS : PATH_DIMS + WORD_DIMS] /= max(1.0, len(words) ** 0.5)
        n = len(leaf.text)
        row[PATH_DIMS + WORD_DIMS :] = (np.log1p(n) / 5, np.log1p(len(words)) / 4, min(1.0, leaf.linked / n), leaf.text[-1] in ".!?", "©" in leaf.text, i / len(page))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTM passes over a page's leaves and a logistic output on both. Weights are float32 arrays by name."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w |= {f"x{d}": draw(DIMS, 4 * HIDDEN), f"h{d}": draw(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.w[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.w |= {"o": draw(2 * HIDDEN, 1), "ob": np.zeros(1, np.float32)}

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        n, steps, _ = x.shape
        z_in = x.reshape(-1, DIMS) @ self.w[f"x{d}"] + self.w[f"b{d}"]
        z_in = z_in.reshape(n, steps, -1)
        h, c = np.zeros((2, n, HIDDEN), np.float32)
        out = np.zeros((n, steps, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_in[:, t] + h @ self.w[f"h{d}"]
            gates, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            m = mask[:, t, None]
            c_next = f * c + i * new
            tc = np.tanh(c_next)
            if keep is not None:
                keep.append((t, h, c, i, f, o, new, tc, m))
            h, c = np.where(m, o * tc, h), np.where(m, c_next, c)
            out[:, t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        h = np.concatenate([self._pass(d, x, mask, None if kept is None else kept.setdefault(d, [])) for d in "fb"], axis=2)
        if kept is not None:
            kept["h"] = h
        return (h @ self.w["o"] + self.w["ob"])[:, :, 0]

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict = {}
        error = np.where(mask, _sigmoid(self.logits(x, mask, kept)) - y, 0).astype(np.float32) / max(1, int(mask.sum()))
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        g["o"] = np.einsum("nth,nt->h", kept["h"], error)[:, None]
        g["ob"] = error.sum(keepdims=True)[0]
        back = error[:, :, None] * self.w["o"][:, 0]
        for k, d in enumerate("fb"):
            above = back[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            dh, dc = np.zeros((2, len(x), HIDDEN), np.float32)
            for t, h, c, i, f, o, new, tc, m in reversed(kept[d]):
                dh = dh + above[:, t]
                own, dc_own = np.where(m, dh, 0), np.where(m, dc, 0)
                dct = dc_own + own * o * (1 - tc * tc)
                dz = np.concatenate([dct * new * i * (1 - i), dct * c * f * (1 - f), own * tc * o * (1 - o), dct * i * (1 - new * new)], axis=1)
                g[f"x{d}"] += x[:, t].T @ dz
                g[f"h{d}"] += h.T @ dz
                g[f"b{d}"] += dz.sum(axis=0)
                dh = np.where(m, dz @ self.w[f"h{d}"].T, dh)
                dc = np.where(m, dct * f, dc)
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 10, rate: float = 0.02, seed: int = 5) -> Labeller:
        rng = np.random.default_rng(seed)
        first, second, step = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2)), None, 0
        first, second = first
        for epoch in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda j: len(pages[j][0]) // 8)
            batches = [order[a : a + 32] for a in range(0, len(order), 32)]
            for b in rng.permutation(len(batches)):
                x, y, mask = _padded([pages[j] for j in batches[b]])
                step += 1
                for k, v in self.gradients(x, y, mask).items():
                    v = np.clip(v, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    self.w[k] -= rate * (0.85**epoch) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each page, which leaves are main text. Pages of like length go through together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted(range(len(pages)), key=lambda j: len(pages[j]))
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and (b - a + 1) * len(pages[order[b]]) <= 8_192:
                b += 1
            own = order[a:b]
            x, _, mask = _padded([(pages[j], np.zeros(len(pages[j]), np.float32)) for j in own])
            if x.shape[1]:
                for j, row in zip(own, self.logits(x, mask), strict=True):
                    out[j] = row[: len(pages[j])] > 0
            a = b
        return out


def _padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(x) for x, _ in pages)
    x, y, mask = np.zeros((len(pages), steps, DIMS), np.float32), np.zeros((len(pages), steps), np.float32), np.zeros((len(pages), steps), bool)
    for k, (a, b) in enumerate(pages):
        x[k, : len(a)], y[k, : len(a)], mask[k, : len(a)] = a, b, True
    return x, y, mask


def made_page(rng: np.random.Generator, words: list[str]) -> list[tuple[Leaf, bool]]:
    """A page of the kinds that tables of crawled pages hold, with its labels."""
    pick = lambda *x: x[rng.integers(len(x))]
    some = lambda a, b: " ".join(words[k] for k in rng.integers(len(words), size=rng.integers(a, b)))
    long = lambda: some(3, 90) + pick(".", ".", ".", "!", "?", "")
    out: list[tuple[Leaf, bool]] = []

    def put(path: str, text: str, main: bool, linked: bool = False) -> None:
        out.append((Leaf(tuple(f"html body {path}".split()), text, len(text) if linked else 0), main))

    def furniture(at: str) -> None:
        name = pick(*sorted(FURNITURE_NAMES))
        kind = rng.integers(7)
        if kind == 0:
            for _ in range(rng.integers(2, 8)):
                put(f"{at} {pick('nav', 'nav', f'div .{name}', 'header', f'header .{name}')} ul li", some(1, 3), False, True)
        elif kind == 1:
            for _ in range(rng.integers(1, 4)):
                put(f"{at} {pick('aside', f'div .{name}', f'section .{name}', f'aside .{name}')} {pick('', 'p', 'div', 'h3', 'ul li')}", long(), False, rng.random() < 0.3)
        elif kind == 2:
            put(f"{at} div .{pick('ad', name)}", some(3, 25), False)
        elif kind == 3:
            for _ in range(rng.integers(1, 4)):
                put(f"{at} form {pick('', f'.{name}')} {pick('p', 'label', 'button', 'div')}", some(1, 12), False)
        elif kind == 4:
            for _ in range(rng.integers(1, 6)):
                put(f"{at} {pick('section', 'div', 'ol', 'aside')} .{pick('comments', 'comment', 'replies', 'discussion', 'commentlist')} {pick('p', 'li', 'div .comment p', 'article .comment p', 'div')}", long(), False)
        elif kind == 5:
            put(f"{at} {pick('div', 'section', 'p')} .{name}", long(), False)
        else:
            put(f"{at} {pick('footer', 'div .footer', 'footer .' + name)} {pick('', 'p', 'div')}", pick("© ", "") + some(2, 20), False)

    for _ in range(rng.integers(0, 5)):
        furniture(pick("", "", "div", "div .wrapper", "header"))
    body = pick("article", "article", "article", "main", "main article", "div .content", "div .post", "div .entry .content", "div .article .body", "section .story", "div .main", "article .post", "div article", "main div")
    if rng.random() < 0.8:
        put(f"{body} {pick('h1', 'h1', 'h2', 'header h1' if 'article' in body else 'h1')}", some(2, 14), True)
    for _ in range(rng.integers(1, 14)):
        put(f"{body} {pick('p', 'p', 'p', 'p', 'p', 'h2', 'h3', 'ul li', 'ol li', 'blockquote p', 'blockquote', '', 'div', 'pre', 'section p', 'table tr td', 'figure figcaption')}", long() if rng.random() < 0.9 else some(1, 4), True, rng.random() < 0.05)
        if rng.random() < 0.08:
            furniture(body)
    for _ in range(rng.integers(0, 5)):
        furniture(pick("", "", body, "div", "div .wrapper"))
    return out


def renamed(page: list[Leaf], rng: np.random.Generator) -> list[Leaf]:
    """The page with a made-up word for each class or id: what is left are elements, order, lengths, links and words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    names: dict[str, str] = {}
    new = lambda: "." + "".join(letters[k] for k in rng.integers(26, size=rng.integers(3, 9)))
    return [Leaf(tuple(names.setdefault(x, new()) if x[0] == "." else x for x in leaf.path), leaf.text, leaf.linked) for leaf in page]


def fit_labeller(sample: list[str]) -> Labeller:
    """Learns from made-up pages, in words of the sample's pages, and from those pages with what their paths say.

    A share of both comes with names that say nothing, and keeps its labels: so elements, order, lengths and links of a
    block and of those round it have to tell furniture whose names are on no list.
    """
    parsed = [p for p in map(leaves, sample) if p]
    words = sorted({w for p in parsed for leaf in p for w in leaf.text.split()})[:20_000] or ["text", "words", "pages"]
    rng = np.random.default_rng(11)
    pages = []
    for p in parsed:
        y = np.array([is_main(x.path) for x in p], np.float32)
        pages.append((vectors(renamed(p, rng) if rng.random() < NAMELESS else p), y))
    for _ in range(MADE_PAGES):
        made = made_page(rng, words)
        page, y = [x for x, _ in made], np.array([y for _, y in made], np.float32)
        pages.append((vectors(renamed(page, rng) if rng.random() < NAMELESS else page), y))
    return Labeller().fit(pages)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of pages: id_col, the carried columns and text: its main blocks in their order, joined by a line feed.

    The labeller is fitted to FIT_PAGES pages at most (picked by a hash of the id) and MADE_PAGES made-up ones, then sees
    every leaf block of every whole page, long or short. Null and empty pages, and pages without main text, have the
    empty text. Ties and repeated rows get the same text; an empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    sample = [r["h"] for r in bounded_sample(pages.where(F.col(html_col).isNotNull()).select(id_col, F.col(html_col).alias("h")), id_col, FIT_PAGES).orderBy(id_col).collect()]
    model = Labeller()
    model.w = in_one_task(pages.sparkSession, lambda: fit_labeller(sample).w)
    schema = T.StructType([T.StructField("_id", pages.schema[id_col].dataType), *(T.StructField(f"_c_{c}", pages.schema[c].dataType) for c in carry), T.StructField("text", T.StringType())])

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                part = pdf.iloc[a : a + 512]
                found = [leaves(h if isinstance(h, str) else None) for h in part["_h"]]
                main = model.label([vectors(p) for p in found])
                yield part.drop(columns="_h").assign(text=["\n".join(leaf.text for leaf, m in zip(p, own, strict=True) if m) for p, own in zip(found, main, strict=True)])

    rows = pages.select(F.col(id_col).alias("_id"), *(F.col(c).alias(f"_c_{c}") for c in carry), F.col(html_col).alias("_h"))
    out = rows.mapInPandas(label, schema)
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_c_{c}").alias(c) for c in carry), "text")
