"""Numbers from text, clipped scores and their categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the categories.
DETRACTOR, NEUTRAL, PROMOTER, UNKNOWN = CATEGORIES = ("Detractor", "Neutral", "Promotor", "Unknown")
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(value: Column) -> Column:
    """A double, or null for what is no plain decimal number (suffixes, nan and inf are none)."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(F.regexp_replace(text, r"\s", "")).try_cast("double"))


def clip_score(score: Column, low: float = 0, high: float = 10) -> Column:
    """Within [low, high]; null stays null, which least() and greatest() alone would not grant."""
    return F.when(score.isNotNull() & ~F.isnan(score), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), score)))


def categorize(score: Column) -> Column:
    """Category of a score that is clipped already."""
    return F.when(score.isNull(), UNKNOWN).when(score <= 6, DETRACTOR).when(score <= 8, NEUTRAL).otherwise(PROMOTER)


def score(value: Column) -> Column:
    return clip_score(to_number(value))
