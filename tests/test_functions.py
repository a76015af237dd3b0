import datetime as dt

import pytest
from pyspark.sql import functions as F

from supplyscope import functions as S


def values(spark, column, data, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_to_long(spark):
    data = ["12", " 12 ", "12.0", "12.", "-3", "1e3", "12.5", "1d", "x", "", None, "9007199254740993"]
    assert values(spark, S.to_long, data) == [12, 12, 12, 12, -3, 1000, None, None, None, None, None, 9007199254740993]


def test_to_number_or_zero(spark):
    data = ["1.5", "2", "", None, "n/a", "1.0"]
    assert values(spark, S.to_number_or_zero, data) == [1.5, 2.0, 0.0, 0.0, 0.0, 1.0]
    assert values(spark, lambda c: S.to_number_or_zero(c, "bigint"), data) == [0, 2, 0, 0, 0, 0]


def test_parse_ts(spark):
    got = values(spark, S.parse_ts, ["2020-01-02", "2020-01-02T03:04:05", "x", "2020-13-01", None])
    assert got == [dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), None, None, None]
    assert values(spark, lambda c: S.parse_ts(c, strict=True), ["2020-01-02", None]) == [dt.datetime(2020, 1, 2), None]
    with pytest.raises(Exception, match="not a timestamp"):
        values(spark, lambda c: S.parse_ts(c, strict=True), ["x"])


def test_week_monday(spark):
    days = ["2024-01-01", "2024-01-03", "2024-01-06", "2024-01-07", "2024-01-08"]
    assert values(spark, S.week_monday, days) == [dt.date(2024, 1, 1)] * 4 + [dt.date(2024, 1, 8)]


def test_clock(spark):
    day = dt.date(2024, 8, 31)
    one = spark.range(1).select(
        S.months_ago(day, 6).alias("m"), S.days_ago(day, 30).alias("d"), S.age_days(F.lit("2023-08-31"), day).alias("a"),
        S.age_days(F.lit("2024-08-30 12:00:00"), dt.datetime(2024, 8, 31, 11)).alias("h"),
    )
    assert tuple(one.first()) == (dt.date(2024, 2, 29), dt.date(2024, 8, 1), 366, 0)


def test_text(spark):
    assert values(spark, S.strip_prefix, ["a:b:c", "b", None]) == ["b:c", "b", None]
    assert values(spark, lambda c: S.remove_text(c, "-eng"), ["x-eng:1-eng", None]) == ["x:1", None]
    assert values(spark, S.is_blank, ["", " \t ", "x", None]) == [True, True, False, True]
    assert values(spark, lambda c: S.ends_with_ci(c, ".pdf"), ["a.PDF", "a.pdfx", None]) == [True, False, False]
    assert values(spark, lambda c: S.recode(c, {"entity": "reference"}), ["entity", "name"]) == ["reference", "name"]
    assert values(spark, lambda c: S.date_text(c), ["2024-01-02T03:04"]) == ["2024-01-02"]
    assert values(spark, lambda c: S.join_code(c, ":", F.lit("b")), ["a", None]) == ["a:b", None]
    assert S.pretty("field_supplied_pct") == "Field Supplied %"
    assert S.pretty("endpoint_no.") == "Endpoint No."
    assert values(spark, S.pretty_text, ["a_pct", "count", "x_count"]) == ["a %", "count", "x "]


def test_first_match_takes_the_first_rule(spark):
    rule = [(".zip", F.lit("zip")), (".doc", F.lit("doc")), (".docx", F.lit("docx"))]
    got = values(spark, lambda c: S.first_match(c, rule, F.lit("none")), ["A.DOCX", "b.zip.doc", "c", None])
    assert got == ["doc", "zip", "none", "none"]


def test_percent_and_bands(spark):
    assert values(spark, S.percent_label, [0.125, 0.005, 1.0, None], "double") == ["12%", "0%", "100%", None]
    assert values(spark, S.decile_band, [0.0, 0.55, 0.99, 1.0, None], "double") == [
        "00-10", "50-60", "90-100", "100", None,
    ]


def test_flags(spark):
    assert values(spark, S.bool_text, [True, False, None], "boolean") == ["TRUE", "FALSE", None]
    assert values(spark, lambda c: S.bool_text(c, invert=True), [True, False, None], "boolean") == ["FALSE", "TRUE", None]
    assert values(spark, lambda c: S.cap(c, 2), [1, 3, None], "int") == [1, 2, None]
    assert values(spark, S.minus_one_to_zero, [-1, -2, 3], "int") == [0, -2, 3]
    assert values(spark, lambda c: S.same(c, F.lit("a")), ["a", "b", None]) == [True, False, False]
    assert values(spark, lambda c: S.yes_no(c > 1), [2, 1, None], "int") == ["yes", "no", "no"]
    assert values(spark, lambda c: S.guarded_ratio(F.lit(6.0), c), [3.0, 0.0, -1.0, None], "double") == [2.0, None, None, None]
    assert values(spark, lambda c: S.fraction(F.lit(6.0), c), [3.0, 0.0], "double") == [2.0, None]


def test_parse_details_reads_python_and_json(spark):
    texts = ["{'a': [1, None], 'b': True}", '{"a": [2], "b": false}', "not parseable", '{"a": [1', None]
    got = values(spark, lambda c: S.parse_details(c, "a array<string>, b boolean"), texts)
    assert [(r and r["a"], r and r["b"]) for r in got] == [
        (["1", None], True), (["2"], False), (None, None), (None, None), (None, None),
    ]


def test_json_value(spark):
    texts = ['{"error": {"code": 499}}', "[1]", "x"]
    assert values(spark, lambda c: S.json_value(c, "$.error.code"), texts) == ["499", None, None]
