"""Grouped scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_by(df: DataFrame, key: str, score: str = "nps_score") -> DataFrame:
    """(key, avg_nps, total, promoters, detractors): one partial and one final aggregation, one exchange of a row per key."""
    s = F.col(score)
    return df.groupBy(key).agg(F.round(F.avg(s), 6).alias("avg_nps"), F.count(F.lit(1)).alias("total"), F.count(F.when(s >= 9, 1)).alias("promoters"), F.count(F.when(s <= 6, 1)).alias("detractors"))


def net_score(df: DataFrame, key: str, score: str = "nps_score") -> DataFrame:
    """Extension: share of promoters less share of detractors, in percent."""
    s = F.col(score)
    share = (F.count(F.when(s >= 9, 1)) - F.count(F.when(s <= 6, 1))) * 100.0 / F.count(s)
    return df.groupBy(key).agg(F.round(share, 6).alias("net_score"), F.count(s).alias("scored"))
