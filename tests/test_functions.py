from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from listenlytics.functions import (
    NULL_TOKENS,
    genre_date,
    has_date,
    listen_date,
    null_if_token,
    percent_text,
    time_is_bad,
    to_long,
)


def test_percent_text_rounds_like_python(spark):
    rates = [(n, d) for d in (16, 18, 32, 37, 64, 200, 333, 400, 1000, 2000, 9999) for n in range(d + 1)]
    df = spark.createDataFrame(rates, "n long, d long").select(
        "n", "d", percent_text(F.col("n").cast("double") / F.col("d")).alias("text")
    )
    wrong = [(r.n, r.d, r.text) for r in df.collect() if r.text != f"{r.n / r.d:.1%}"]
    assert wrong == []


def test_listen_date(spark):
    cases = {
        "2024-01-15 10:00:00": datetime.date(2024, 1, 15),
        "2024-01-15T23:59:59Z": datetime.date(2024, 1, 15),
        "2024-01-15T23:30:00-05:00": datetime.date(2024, 1, 16),
        "2024-01-15": datetime.date(2024, 1, 15),
        "2024-01-15 at noon": datetime.date(2024, 1, 15),
        "12:30:00": None,
        "01/15/2024": None,
        "2024-02-30": None,
        "1705312800": None,
        "not-a-time": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string").select(
        "t", listen_date(F.col("t")).alias("d"), has_date(F.col("t")).alias("has")
    )
    assert {r.t: r.d for r in df.collect()} == cases
    assert {r.t for r in df.collect() if r.has} == {t for t, d in cases.items() if d}


def test_formats(spark):
    df = spark.createDataFrame([("01/15/2024 10:00",), ("2024-01-15 10:00:00",), ("x",)], "t string")
    formats = ["MM/dd/yyyy HH:mm"]
    got = df.select(
        listen_date(F.col("t"), formats).cast("string").alias("d"),
        time_is_bad(F.col("t"), formats).alias("bad"),
        has_date(F.col("t"), formats).alias("has"),
    ).collect()
    assert [(r.d, r.bad, r.has) for r in got] == [
        ("2024-01-15", False, True),
        ("2024-01-15", False, True),
        (None, True, False),
    ]


def test_to_long(spark):
    df = spark.createDataFrame([("12",), ("oops",), (None,)], "t string")
    assert [r[0] for r in df.select(to_long(F.col("t"))).collect()] == [12, None, None]


def test_null_tokens(spark):
    df = spark.createDataFrame([(t,) for t in [*NULL_TOKENS, "NAN", "x", None]], "t string")
    kept = [r[0] for r in df.select(null_if_token(F.col("t"))).collect()]
    assert [k for k in kept if k is not None] == ["NAN", "x"]


def test_genre_date(spark):
    df = spark.sql("select 'a#b' as g, date'2024-01-05' as d")
    assert df.select(genre_date(F.col("g"), F.col("d"))).first()[0] == "a#b#2024-01-05"
