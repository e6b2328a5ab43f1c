"""Answer lists: JSON text with one object per answered question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.columns import col
from ..sources.scratch import spread, written_once
from .encoding import fix_encoding
from .jsonrepair import STRICT, fix_json, let

# Question ids and the columns of their answers; other ids go to metric_<id>.
COLUMNS = {
    "nps_rate_recomendation": "nps_recomendacion_score",
    "nps_text_recomendation": "nps_recomendacion_motivo",
    "csat_rate_satisfied": "csat_satisfaccion_score",
    "csat_text_satisfied": "csat_satisfaccion_motivo",
}
#: Columns that answers are expanded into, at most; more ids mean that the id field holds something else.
MOST_QUESTIONS = 2_000
PREFIX, ID_KEY, VALUE_KEY = "metric_", "subQuestionId", "answerValue"


ITEM = f"struct<{ID_KEY} variant, {VALUE_KEY} variant>"


def float_text(java: Column) -> Column:
    """A double as Spark writes it, in as many digits: without an exponent from 0.0001 to below 10**16, else with one of a sign and two digits or more."""
    part = lambda i: F.regexp_extract(java, r"^(-?)(\d)\.(\d+)E(-?\d+)$", i)
    sign, first, rest, e = part(1), part(2), F.when(part(3) != "0", part(3)).otherwise(""), part(4).try_cast("int")
    digits = F.concat(first, rest)
    longer = F.concat(digits, F.repeat(F.lit("0"), e + 1 - F.length(digits)), F.lit(".0"))
    cut = F.concat(digits.substr(F.lit(1), e + 1), F.lit("."), digits.substr(e + 2, F.length(digits)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    power = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
    other = F.concat(first, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), power)
    moved = F.when((e >= 0) & (e < 16), F.when(F.length(digits) <= e + 1, longer).otherwise(cut)).when((e < 0) & (e >= -4), small).otherwise(other)
    named = F.when(java == "NaN", "nan").when(java == "Infinity", "inf").when(java == "-Infinity", "-inf")
    return F.coalesce(named, F.when(F.contains(java, F.lit("E")), F.concat(sign, moved)).otherwise(java))


def rendered(value: Column, item: Column, key: str) -> Column:
    """The text of a field by its JSON type: texts as they are, true is True, null is None, whole numbers are their digits, others float_text(); empty if the item has no such field.

    Lists and objects are their JSON text. What a variant can't hold (an object that repeats a key inside the value, a
    whole number of over 38 digits) is taken from the item's text.
    """
    kind = F.schema_of_variant(value)
    raw = F.try_element_at(F.from_json(item, "map<string,string>", STRICT), F.lit(key))
    number = F.when(F.rlike(raw, F.lit(r"^-?\d+$")), raw).otherwise(float_text(F.try_variant_get(value, "$", "double").cast("string")))
    return (
        F.when(value.isNull(), F.coalesce(raw, F.lit("")))
        .when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        .when(kind == "BIGINT", F.try_variant_get(value, "$", "string"))
        .when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.when(F.try_variant_get(value, "$", "boolean"), "True").otherwise("False"))
        .when((kind == "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), number)
        .otherwise(raw)
    )


def items(text: Column) -> Column:
    """array<struct<id, value>> of an answer list; an empty one for anything else.

    Encoding is repaired before and, as escapes only turn into characters then, after the JSON is read. Items that are
    no objects are left out; a missing id or value is empty, others are rendered() by type. Of a field that an item
    repeats the last one counts.
    """
    listed = F.from_json(fix_json(fix_encoding(text)), "array<string>", STRICT)
    objects = F.filter(listed, lambda x: F.startswith(F.trim(x), F.lit("{")))
    read = lambda x: let(F.from_json(x, ITEM, STRICT), lambda s: F.struct(rendered(s[ID_KEY], x, ID_KEY).alias("id"), let(rendered(s[VALUE_KEY], x, VALUE_KEY), lambda v: fix_encoding(v)).alias("value")))
    return F.coalesce(F.transform(objects, read), F.array().cast("array<struct<id:string,value:string>>"))


def answer(listed: Column, question: str) -> Column:
    """The last answer to a question, null without one."""
    return F.try_element_at(F.filter(listed, lambda x: x["id"] == question), F.lit(-1))["value"]


def column_of(question: str) -> str:
    return COLUMNS.get(question, PREFIX + question)


def questions(df: DataFrame, listed: Column) -> list[str]:
    """Question ids that occur, known ones first, then by name. One small distinct job; at most MOST_QUESTIONS ids, no answers, reach the driver."""
    found = {r[0] for r in df.select(F.explode(F.transform(listed, lambda x: x["id"]))).distinct().limit(MOST_QUESTIONS + 1).collect()}
    if len(found) > MOST_QUESTIONS:
        raise ValueError(f"more than {MOST_QUESTIONS} question ids: a table can't have a column for each")
    return in_order(found)


def in_order(found: set[str]) -> list[str]:
    return [q for q in COLUMNS if q in found] + sorted(found - set(COLUMNS))


def expand(df: DataFrame, text_col: str = "answers", ids: list[str] | None = None, parsed: str | None = None) -> DataFrame:
    """df with a column per question. A column that is there already would be hidden by its namesake: that is an error.

    Without ids the rows are written down with their parsed answers (scratch.written_once()): the job that finds the
    questions and the projection both read these, so each text is repaired and parsed once. parsed: a column that has
    the items already, if ids are given.
    """
    name = "_items"
    while name in df.columns:
        name += "_"
    if ids is None:
        listed = written_once(spread(df).withColumn(name, items(col(text_col))), "answers")
        ids = questions(listed, F.col(name))
    else:
        listed = df.withColumn(name, items(col(text_col)) if parsed is None else col(parsed))
    names = {column_of(q): answer(F.col(name), q) for q in ids}
    if clash := sorted(set(names) & set(df.columns)):
        raise ValueError(f"answers would overwrite columns: {clash}")
    return listed.withColumns(names).drop(name)
