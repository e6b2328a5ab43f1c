"""Golden cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from sondeo.functions import answers, dates, jsonrepair, scores, text
from sondeo.functions.encoding import PLAIN_RULES, encoding_hits, fix_encoding

SHY, C81 = "­", "\u0081"


def values(spark, inputs, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, x string")
    return [tuple(r)[1:] for r in df.select("i", *(e(F.col("x")).alias(f"e{k}") for k, e in enumerate(exprs))).orderBy("i").collect()]


def test_encoding(spark):
    cases = [("aplicaciÃ³n", "aplicación", 1), ("Ã³ y Ã³", "ó y ó", 1), ("Â¿QuÃ©?", "¿Qué?", 2), ("Â¿QuÃ©?Â", "¿Qué?", 3), ("ExcelenteÂ app", "Excelente app", 1), ("Ã‰xito", "Í‰xito", 1), ("ÃšTIL", "ÍšTIL", 1), ("Ã±Ã", "ñÍ", 2), ("Ã" + SHY, "í", 1), ("Ã" + C81, "Í" + C81, 1), ("são", "são", 0), (None, None, 0)]
    assert values(spark, [c[0] for c in cases], fix_encoding, encoding_hits) == [c[1:] for c in cases]
    assert values(spark, ["Ã‰xitoÂ"], lambda x: fix_encoding(x, PLAIN_RULES)) == [("Ã‰xito",)]


def test_json_repair(spark):
    cases = [
        ('[{"a": 1}]', '[{"a": 1}]', "valid"),
        ("[{'a': 'b c', 'n': 9}]", '[{"a": "b c", "n": 9}]', "fixed"),
        ("[{'a': ''}]", '[{"a": ""}]', "fixed"),
        ("[{'a': \"don't\"}]", '[{"a": "don\'t"}]', "fixed"),
        ("[{'año': 1}]", '[{"año": 1}]', "fixed"),
        ("[{'a': 'it\\'s'}]", "[]", "corrupted"),
        ("[{'a': 'say \"hi\"'}]", "[]", "corrupted"),
        ("[{'a': None}]", "[]", "corrupted"),
        ("[{'a-b': 1}]", "[]", "corrupted"),
        ("[{'t': ['x', 'y']}]", "[]", "corrupted"),
        ("['k': 'v']", "[]", "corrupted"),
        ('[{"a": 1}] xx', "[]", "corrupted"),
        (None, None, None),
    ]
    assert values(spark, [c[0] for c in cases], jsonrepair.fix_json, jsonrepair.json_outcome) == [c[1:] for c in cases]


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, {}),
        ("", {}),
        ("[]", {}),
        ("[{'subQuestionId': 'nps_rate_recomendation', 'answerValue': 9}]", {"nps_rate_recomendation": "9"}),
        ('[{"subQuestionId": "nps_rate_recomendation", "answerValue": 9.0}]', {"nps_rate_recomendation": "9.0"}),
        ('[{"subQuestionId":"nps_text_recomendation","answerValue":"ExcelenteÂ aplicaciÃ³n"}]', {"nps_text_recomendation": "Excelente aplicación"}),
        ('[{"subQuestionId":"q","answerValue":"di\\u00c3\\u00b3"}]', {"q": "dió"}),
        ('[1, {"subQuestionId":"csat_rate_satisfied","answerValue":4}]', {"csat_rate_satisfied": "4"}),
        ('[{"subQuestionId":"a","answerValue":3},{"subQuestionId":"a","answerValue":9}]', {"a": "9"}),
        ('{"subQuestionId":"nps_rate_recomendation","answerValue":9}', {}),
        ('[{"subQuestionId":"a"}]', {"a": ""}),
        ('[{"subQuestionId":"a","answerValue":null}]', {"a": "None"}),
        ('[{"subQuestionId":"a","answerValue":true}]', {"a": "True"}),
        ('[{"answerValue":1}]', {"": "1"}),
        ('[{"subQuestionId":"a","answerValue":"true"},{"subQuestionId":"b","answerValue":false}]', {"a": "true", "b": "False"}),
        ('[{"subQuestionId":"a","answerValue":1e2},{"subQuestionId":"b","answerValue":"1e2"}]', {"a": "100.0", "b": "1e2"}),
        ('[{"subQuestionId":"a","answerValue":"null"},{"subQuestionId":"b","answerValue":"None"}]', {"a": "null", "b": "None"}),
        ('[{"subQuestionId":1,"answerValue":9.10},{"subQuestionId":null,"answerValue":-0}]', {"1": "9.1", "None": "0"}),
        ('[{"subQuestionId":true,"answerValue":12345678.25},{"subQuestionId":"","answerValue":1e16}]', {"True": "12345678.25", "": "1e+16"}),
        ('[{"subQuestionId":"a","answerValue":1,"answerValue":2}]', {"a": "2"}),
        ('[{"subQuestionId":"a","answerValue":{"x":1,"x":2}},{"subQuestionId":"b","answerValue":[1, true]}]', {"a": '{"x":1,"x":2}', "b": "[1,true]"}),
        ('[{"subQuestionId":"a","answerValue":99999999999999999999999999999999999999999}]', {"a": "9" * 41}),
        ('[{"subQuestionId":"a","answerValue":-1.5E-7},{"subQuestionId":"b","answerValue":0.00001}]', {"a": "-1.5e-07", "b": "1e-05"}),
        ("[{'subQuestionId': 'a', 'answerValue': true}]", {"a": "True"}),
    ],
)
def test_answer_items(spark, raw, want):
    [(found,)] = values(spark, [raw], answers.items)
    assert {x["id"]: x["value"] for x in found} == want


def test_floats_are_written_as_shortest_decimals(spark):
    import random

    rng = random.Random(1)
    numbers = [0.0, -0.0, 1.0, 9.1, 100.0, 1e7, 12345678.25, 1e15, 1e16, 123456789012345.6, 0.001, 0.0001, 0.00012, 1e-5, -2.5e-9, 1e22, 1e23, 1.7e308, 5e-324, float("inf"), -float("inf")]
    numbers += [round(rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 20), rng.randint(0, 12)) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    got = [r.t for r in df.select("i", answers.float_text(F.col("x").cast("string")).alias("t")).orderBy("i").collect()]
    assert [float(t) for t in got] == numbers
    short = [(t, repr(x)) for t, x in zip(got, numbers, strict=True) if len(repr(x).strip("-").partition("e")[0]) <= 12]
    assert len(short) > 100 and {a for a, b in short if a != b} <= {"4.9e-324", "9.999999999999999e+22"}  # Java does not always find the shortest digits


def test_expand_names_columns_and_refuses_clashes(spark):
    df = spark.createDataFrame([(1, '[{"subQuestionId":"z","answerValue":1},{"subQuestionId":"csat_rate_satisfied","answerValue":4}]')], "id int, answers string")
    out = answers.expand(df)
    assert out.columns == ["id", "answers", "csat_satisfaccion_score", "metric_z"]
    with pytest.raises(ValueError):
        answers.expand(df.withColumn("metric_z", F.lit(1)))


def test_scores(spark):
    cases = [("-3", 0.0, "Detractor"), ("6", 6.0, "Detractor"), ("6.5", 6.5, "Neutral"), ("8", 8.0, "Neutral"), ("8.5", 8.5, "Promotor"), ("9", 9.0, "Promotor"), ("15", 10.0, "Promotor"), ("", None, "Unknown"), ("abc", None, "Unknown"), ("9d", None, "Unknown"), ("nan", None, "Unknown"), (None, None, "Unknown"), (" 7 ", 7.0, "Neutral"), ("1e1", 10.0, "Promotor")]
    assert values(spark, [c[0] for c in cases], scores.score, lambda x: scores.categorize(scores.score(x))) == [c[1:] for c in cases]


def test_urls_and_feedback(spark):
    urls = [(" https://x.y/a?b=1#f ", "https://x.y/a"), ("https://x.y/a#f", "https://x.y/a#f"), ("?a=1", ""), (None, ""), ("", ""), ("nan", ""), ("NaN", "NaN"), (" nan ", "nan")]
    assert values(spark, [u[0] for u in urls], text.clean_url) == [u[1:] for u in urls]
    said = [("¡Excelente! (10/10) 👍", "Excelente! 1010 "), ("¿ hola", " hola"), ("Ñandú ü_9; ok-", "Ñandú ü_9; ok-"), ('"cita" 50% @x', "cita 50 x"), ("a\nb", "a\nb"), (None, ""), ("", ""), ("nan", "")]
    assert values(spark, [s[0] for s in said], text.clean_feedback) == [s[1:] for s in said]


def test_dates(spark):
    at = lambda x: F.date_format(dates.to_wall_clock(x), "yyyy-MM-dd HH:mm")
    cases = [("2025-08-01T10:00:00-05:00", "2025-08-01 10:00", "2025-08"), ("2025-08-01 10:00:00", "2025-08-01 10:00", "2025-08"), ("8/1/2025 10:00", "2025-08-01 10:00", "2025-08"), ("nope", None, None), (None, None, None)]
    assert values(spark, [c[0] for c in cases], at, lambda x: dates.month_year(dates.to_wall_clock(x))) == [c[1:] for c in cases]


def test_a_column_is_read_in_one_order(spark):
    rows = [("13/1/2025", "8/1/2025 10:00", "1-13-2025", "2025-08-01"), ("8/1/2025", "1/13/2025 9:05:07", "2-3-2025", "5/6/2025"), ("5-6-2025", "13/1/2025", "14-2-2025 1:02", None), (None, "x", "3-25-2025", "")]
    df = spark.createDataFrame(rows, "a string, `b c` string, d string, e string").withColumn("n", F.lit(1))
    found = dates.column_formats(df, ["a", "b c", "d", "e", "n", "no such column"])
    assert set(found) == {"a", "b c", "d", "e"}
    at = lambda x, f: F.date_format(dates.to_wall_clock(x, f), "MM-dd HH:mm")
    got = df.select(*(at(F.col(f"`{n}`"), found[n]).alias(n) for n in found)).collect()
    assert [r.a for r in got] == ["01-13 00:00", "01-08 00:00", "06-05 00:00", None]
    assert [r["b c"] for r in got] == ["08-01 10:00", "01-13 09:05", None, None]
    assert [r.d for r in got] == ["01-13 00:00", "02-03 00:00", None, "03-25 00:00"]
    assert [r.e for r in got] == ["08-01 00:00", "05-06 00:00", None, None]
    assert dates.column_formats(df.select("n"), ["n"]) == {} and dates.column_formats(df.where("false"), ["a"])["a"] == dates.FORMATS
