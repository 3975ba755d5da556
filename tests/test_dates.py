"""Spellings of dates against a calendar: every order, separator and name of the grammar."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from civicflow.functions import normalize as N
from civicflow.functions.dates import MONTHS


def read(spark, spellings):
    df = spark.createDataFrame(list(enumerate(spellings)), "i int, v string")
    rows = df.select("i", N.day("v").alias("d"), N.ts("v").alias("t"), N.year_month("v").alias("ym"),
                     N.day_invalid("v").alias("bad")).orderBy("i").collect()
    return [(r.d, r.t, r.ym, r.bad) for r in rows]


def test_spellings_of_whole_dates(spark):
    cases = []
    for day in (dt.date(2024, 2, 29), dt.date(1999, 12, 31), dt.date(2021, 3, 4), dt.date(2010, 9, 10)):
        y, m, d = day.year, day.month, day.day
        name = MONTHS[m - 1]
        for sep in ".-/ ":
            cases += [(f"{y}{sep}{m:02}{sep}{d:02}", day), (f"{y}{sep}{m}{sep}{d}", day),
                      (f"{m}{sep}{d}{sep}{y}", day)]
            if d > 12:
                cases.append((f"{d}{sep}{m}{sep}{y}", day))
        for n, sep in itertools.product((name, name[:3], name.title(), name[:3].upper()), " -/"):
            cases += [(sep.join((str(d), n, str(y))), day), (sep.join((n, str(d), str(y))), day),
                      (sep.join((str(y), n, str(d))), day)]
        cases += [(f"{y}{m:02}{d:02}", day), (f"{d}. {name} {y}", day), (f"{name} {d}, {y}", day),
                  (f"{name} {d}th, {y}", day), (f"{d}th of {name} {y}", day), (f" {day:%A}, {d} {name} {y} ", day)]
    assert len(cases) > 200
    for (text, day), (d, t, ym, bad) in zip(cases, read(spark, [c[0] for c in cases])):
        assert (d, t, ym, bad) == (day, dt.datetime.combine(day, dt.time()), f"{day:%Y-%m}", False), text


def test_month_first_unless_the_first_number_is_too_large(spark):
    got = [r[0] for r in read(spark, ["03.04.2020", "13.04.2020", "04/13/2020", "12/12/12", "31.12.99", "99-Jan-02", "1 Feb 74"])]
    assert got == [dt.date(2020, 3, 4), dt.date(2020, 4, 13), dt.date(2020, 4, 13), dt.date(2012, 12, 12),
                   dt.date(1999, 12, 31), dt.date(1999, 1, 2), dt.date(2074, 2, 1)]


def test_parts_are_filled_with_the_first(spark):
    got = [r[0] for r in read(spark, ["May 2020", "2020 May", "05/2020", "2020/05", "2020-05", "2020", "200506"])]
    assert got == [dt.date(2020, 5, 1)] * 5 + [dt.date(2020, 1, 1), dt.date(2020, 5, 6)]


def test_times_and_zones(spark):
    cases = {"4 Mar 2021 10:20": (10, 20, 0, 0), "03/04/2021 10:20:30.25": (10, 20, 30, 250_000),
             "Mar 4 2021, 10:20 pm": (22, 20, 0, 0), "Mar 4 2021 12:05 a.m.": (0, 5, 0, 0),
             "2021-03-04T10:20:30+0200": (8, 20, 30, 0), "2021-03-04T10:20:30Z": (10, 20, 30, 0),
             "20210304 10:20 UTC": (10, 20, 0, 0)}
    for (text, (h, m, s, f)), row in zip(cases.items(), read(spark, list(cases))):
        assert row[1] == dt.datetime(2021, 3, 4, h, m, s, f), text
        assert row[0] == dt.date(2021, 3, 4)


def test_what_is_no_date(spark):
    texts = ["x", "31.02.2020", "2020-13-01", "13/13/2020", "May", "4 May", "10:20", "5 Mai 2020", "1 2 3 4",
             "2020-02-30", "20201399", "12345", "2020 May June", "١/1/2020"]
    for text, row in zip(texts, read(spark, texts)):
        assert row == (None, None, None, True), text
    assert read(spark, ["", "  "]) == [(None, None, None, False)] * 2


def test_line_ends_and_words_at_the_end(spark):
    texts = ["2020/05/06\n", "2020/05/06\nmonday", "m5 2020", "M5 2020", "5th of sept, 2020"]
    assert [r[0] for r in read(spark, texts)] == [dt.date(2020, 5, 6), None, None, None, dt.date(2020, 9, 5)]


def test_expressions_are_small(spark):
    """F3 to F22: the flatteners' plans hold some hundred dates; each is sent with every task."""
    df = spark.createDataFrame([("4 Mar 2020",)], "v string")
    for read_as in (N.ts, N.day, N.year_month):
        plan = df.select(read_as("v").alias("x"))._jdf.queryExecution().analyzed().toString()
        assert "lambda" not in plan and len(plan) < 5_000
