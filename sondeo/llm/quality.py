"""Quality scores from a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "spaces", "marks", "symbols", "bars", "exclaims", "distinct_words", "distinct_lines", "line_length", "entropy", "stops", "symbol_words")
#: Shares of the pooled covariance and of the identity in each class's covariance.
TO_POOLED, TO_IDENTITY = 0.15, 0.02
#: Standardised statistics are cut here, so that one odd statistic alone can't decide.
CUT = 4.0

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:?'\"()-"]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = True


def statistics(text: str | None) -> list[float]:
    """The FEATURES of one whole text, each on a scale near one; of an empty or null text, those of no characters."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(1, len(data))
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    w = max(1, len(words))
    share = counts[counts > 0] / n
    marked = sum(1 for x in words if not x[-1].isalnum() and x[-1] not in ".,;:?!\"')") if words else 0
    letters = max(1, n - int(counts[_WHITE].sum()))
    upper = sum(1 for x in words if len(x) > 1 and x.isupper())
    root = lambda x: math.sqrt(max(0.0, x))
    return [
        math.log1p(len(text)) / 3,
        math.log1p(len(words)) / 3,
        math.log1p(letters / w),
        root((upper / w + counts[_UPPER].sum() / letters) / 2),
        root(counts[_DIGIT].sum() / n),
        root(counts[_WHITE].sum() / n),
        root(counts[_MARK].sum() / n),
        root(counts[_SYMBOL].sum() / n),
        root(counts[124] / w),
        root(counts[33] / w),
        root(len(set(words)) / w),
        root(len(set(lines)) / max(1, len(lines))),
        math.log1p(len(words) / max(1, len(lines))) / 2,
        float(-(share * np.log2(share)).sum()) / 4,
        root(sum(1 for x in words if len(x) <= 3) / w),
        root(marked / w),
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "_stats") -> DataFrame:
    """docs with one more column: the FEATURES of each text. Only texts go to Python, only numbers come back."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def add(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(x if isinstance(x, str) else None) for x in texts])

    return docs.withColumn(name, add(F.col(text_col)))


def lower_inverse(factor: np.ndarray) -> np.ndarray:
    """Of a lower triangular matrix, by forward substitution; with it a distance is one product."""
    out = np.zeros_like(factor)
    for i in range(len(factor)):
        row = -(factor[i, :i, None] * out[:i]).sum(axis=0)
        row[i] += 1
        out[i] = row / factor[i, i]
    return out


@dataclass
class Discriminant:
    """Two Gaussian classes with shrunken covariances; each keeps its Cholesky factor, that factor's inverse and the log-determinant."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    inverses: list[np.ndarray]
    log_dets: list[float]
    log_prior: float

    @classmethod
    def fit(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], d: int) -> Discriminant:
        """moments: of label 0 and 1 the count, the sum and the sum of outer products. A label without rows gets those of all rows."""
        zero = (0.0, np.zeros(d), np.zeros((d, d)))
        parts = [moments.get(k, zero) for k in (0, 1)]
        n = sum(p[0] for p in parts)
        if not n:
            one = np.eye(d)
            return cls(np.zeros(d), np.ones(d), [np.zeros(d)] * 2, [one, one], [one, one], [0.0, 0.0], 0.0)
        centre = sum(p[1] for p in parts) / n
        second = sum(p[2] for p in parts) / n - np.outer(centre, centre)
        scale = np.sqrt(np.maximum(np.diag(second), 1e-6))
        means, covariances = [], []
        for count, total, outer in parts:
            if count == 0:
                count, total, outer = n, sum(p[1] for p in parts), sum(p[2] for p in parts)
            mean = total / count
            means.append((mean - centre) / scale)
            covariances.append((outer / count - np.outer(mean, mean)) / np.outer(scale, scale))
        pooled = sum(max(p[0], 1) * c for p, c in zip(parts, covariances, strict=True)) / sum(max(p[0], 1) for p in parts)
        shrunk = [(1 - TO_POOLED - TO_IDENTITY) * c + TO_POOLED * pooled + TO_IDENTITY * np.eye(d) for c in covariances]
        factors = [np.linalg.cholesky(c + 1e-9 * np.eye(d)) for c in shrunk]
        prior = math.log((parts[1][0] + 1) / (parts[0][0] + 1))
        return cls(centre, scale, means, factors, [lower_inverse(f) for f in factors], [2 * float(np.log(np.diag(f)).sum()) for f in factors], prior)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Of label 1 against label 0, for rows of statistics."""
        z = np.clip((x - self.centre) / self.scale, -CUT, CUT)
        logs = [-0.5 * (np.square((z - m) @ f.T).sum(axis=1) + det) for m, f, det in zip(self.means, self.inverses, self.log_dets, strict=True)]
        return logs[1] - logs[0] + self.log_prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of label 1, with log odds divided by the root of the number of statistics.

        Two Gaussians add up what each statistic says as if it were new, but statistics of one text repeat each other beyond
        what covariances show, so raw log odds of held-out texts are too sure in either direction. Dividing keeps their
        order, and so the AUC, and leaves scores that spread over 0 to 1, where a threshold other than 1/2 means something.
        """
        odds = self.log_odds(x) / math.sqrt(len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(labelled: DataFrame, stats: str = "_stats", label: str = "quality") -> Discriminant:
    """Fits to all rows of labelled whose label is 0 or 1. Moments are summed by partition, then by entry: 2 * (d*d + d + 1) numbers reach the driver."""
    d = len(FEATURES)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
        for pdf in batches:
            for k, own in pdf.groupby(label):
                x = np.array(own[stats].tolist(), float)
                sums[int(k)] += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        for k, v in sums.items():
            if v[0]:
                yield pd.DataFrame({"label": k, "at": np.arange(len(v), dtype=np.int32), "value": v})

    sums = labelled.where(F.col(label).isin(0, 1)).select(stats, label).mapInPandas(moments, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    found = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for r in sums.collect():
        found[r["label"]][r["at"]] = r["value"]
    return Discriminant.fit({k: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for k, v in found.items() if v[0]}, d)


def with_scores(rows: DataFrame, model: Discriminant, stats: str = "_stats", name: str = "score") -> DataFrame:
    """rows with the model's score in place of the statistics."""

    @F.pandas_udf("double")
    def add(values: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(values.tolist(), float).reshape(len(values), len(FEATURES))))

    return rows.withColumn(name, add(F.col(stats))).drop(stats)


def one_label(labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row per id: of an id labelled more than once, the smallest label; null ids and labels go."""
    return labels.where(f"{id_col} is not null and {label} in (0, 1)").groupBy(id_col).agg(F.min(label).alias(label))


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True for ids whose CRC-32 of their text is 0 modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0
