"""Golden cases for the normalizers and small ingest rules."""

import datetime as dt

from pyspark.sql import functions as F

from civicflow.functions import normalize as N


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col("v")).alias("r")).first()["r"]


def test_ts(spark):
    assert one(spark, N.ts, "") is None
    assert one(spark, N.ts, "2024-03-01T10:00:00+01:00") == dt.datetime(2024, 3, 1, 9, 0)
    assert one(spark, N.ts_invalid, "not a date") is True
    assert one(spark, N.ts_invalid, "") is False


def test_day_keeps_text_date(spark):
    assert one(spark, N.day, "2024-03-01T00:30:00+01:00") == dt.date(2024, 3, 1)


def test_year_month(spark):
    got = [one(spark, N.year_month, v) for v in (" 2023-05 ", "2023-05-17", "x", "")]
    assert got == ["2023-05", "2023-05", None, None]


def test_simple_list(spark):
    r = one(spark, lambda c: N.simple_list(c, "email"), '["a","",{"email":"b"}]')
    assert [(x["ordinal"], x["value"]) for x in r] == [(1, "a"), (3, "b")]
    r = one(spark, lambda c: N.simple_list(c, "email"), "a")
    assert [(x["ordinal"], x["value"]) for x in r] == [(1, "a")]


def label(spark, code, de, en=None):
    df = spark.createDataFrame([((code, de, en),)], "l struct<code:string,de:string,en:string>")
    return df.select(N.label_key(F.col("l")).alias("k")).first()["k"]


def test_label_key(spark):
    assert label(spark, None, "D") == "D"
    assert label(spark, None, None) is None
    assert label(spark, "", None) == "UNKNOWN"
    assert label(spark, "c1", "X") == "c1"


def test_country_without_code_is_invalid(spark):
    df = spark.createDataFrame([((None, "D", None),)], "c struct<code:string,de:string,en:string>")
    assert df.select(N.country_invalid(F.col("c"))).first()[0] is True


def test_phone_fallback(spark):
    df = spark.createDataFrame([(("", "1"),)], "c struct<phoneNumber:string,phone:string>")
    assert df.select(N.phone(F.col("c"))).first()[0] == "1"


def test_gate(spark):
    df = spark.createDataFrame([(False, ("x",))], "f boolean, o struct<a:string>")
    assert df.select(N.gate(F.col("f"), F.col("o"))).first()[0] is None


def test_label_first_writer(spark):
    from civicflow.operators.flatten import label_dimensions
    uses = spark.createDataFrame(
        [("d", "c1", None, None, (("p", 1), [0])), ("d", "c1", "X", None, (("p", 2), [0])),
         ("d", "c1", "Y", "Z", (("p", 3), [0]))],
        "domain string, code string, de string, en string, "
        "seq struct<o: struct<_page: string, _pos: int>, path: array<long>>")
    code_label, _ = label_dimensions(uses)
    r = code_label.first()
    assert (r["code"], r["de"], r["en"]) == ("c1", "X", "Z")
