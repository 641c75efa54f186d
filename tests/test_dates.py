"""Mixed-format, day-first date parsing vectors."""

from __future__ import annotations

import datetime as dt
import random
import warnings

import pandas as pd

from ledgerline.functions.dates import date_id, parse_mixed_dates, with_mixed_dates

VECTORS = [
    ("21-01-2024 14:00:00", dt.datetime(2024, 1, 21, 14, 0)),
    ("01-02-2024", dt.datetime(2024, 2, 1)),
    ("01-13-2024", dt.datetime(2024, 1, 13)),      # month-first fallback
    ("13/01/2024 5:06", dt.datetime(2024, 1, 13, 5, 6)),
    ("1/2/24", dt.datetime(2024, 2, 1)),
    ("1 Feb 2024 3pm", dt.datetime(2024, 2, 1, 15, 0)),
    ("2024-02-01", dt.datetime(2024, 2, 1)),       # ISO ignores day-first
    ("2024/02/01", dt.datetime(2024, 2, 1)),
    ("20240201", dt.datetime(2024, 2, 1)),
    ("2024-13-01", dt.datetime(2024, 1, 13)),      # year-day-month fallback
    ("02-Jan-2024", dt.datetime(2024, 1, 2)),
    ("x", None),
    ("", None),
    ("31-02-2024", None),
    (None, None),
    # fractions, zones (as UTC), month and weekday names
    ("2024-01-15 10:00:00.500", dt.datetime(2024, 1, 15, 10, 0, 0, 500000)),
    ("2024-01-15T10:00:00Z", dt.datetime(2024, 1, 15, 10, 0)),
    ("2024-01-15T10:00:00.123+05:30", dt.datetime(2024, 1, 15, 4, 30, 0, 123000)),
    ("2024-01-15 23:30 -0330", dt.datetime(2024, 1, 16, 3, 0)),
    ("2024-01-15 10:00:00 +02", dt.datetime(2024, 1, 15, 8, 0)),
    ("1/2/2024 10:00 UTC", dt.datetime(2024, 2, 1, 10, 0)),
    ("2024-01-15 10:00:00.1234567", dt.datetime(2024, 1, 15, 10, 0, 0, 123456)),
    ("January 15, 2024", dt.datetime(2024, 1, 15)),
    ("15-January-2024", dt.datetime(2024, 1, 15)),
    ("2024-Jan-15", dt.datetime(2024, 1, 15)),
    ("Mon, 15 Jan 2024", dt.datetime(2024, 1, 15)),
    ("MONDAY, 5th of March 2024 at 3 p.m.", dt.datetime(2024, 3, 5, 15, 0)),
    # times of day that are none, zones without an offset, words without a meaning
    ("15/01/2024 24:00", None),
    ("15/01/2024 10:00:60", None),
    ("15/01/2024 13pm", None),
    ("15/01/2024 10:", None),
    ("1/2/2024 10:00 EST", None),
    ("15 foo 2024", None),
    ("15 Jan", None),
    ("10:00", None),
    ("1 2 3 4 5", None),
    ("99999999999999999999", None),
    ("\u0661/2/2024", None),
]

# Texts that the calls of the batch loader read the same way as the library's reader.
NAMES = [dt.date(2024, m, 1).strftime("%B") for m in range(1, 13)]
FORMS = ["{d:02}-{m:02}-{y}", "{d}/{m}/{y}", "{d}.{m}.{y}", "{d} {m} {y}", "{y}-{m:02}-{d:02}", "{y}/{m}/{d}", "{y}.{m}.{d}",
         "{y} {m:02} {d:02}", "{d}/{m}/{yy:02}", "{d}-{mon}-{y}", "{d} {month} {y}", "{mon} {d} {y}", "{month} {d}, {y}",
         "{y}-{mon}-{d}", "{y}{m:02}{d:02}", "{d:02}-{mon}-{yy:02}", "{wd}, {d} {mon} {y}", "{mon} {y}", "{y}-{m}",
         "{m}-{y}", "{y}", "{d} {y} {mon}", "{y}{m:02}{d:02}T{h:02}{mi:02}", "{y}{m:02}{d:02}{h:02}{mi:02}{s:02}",
         "{y}-{m:02}-{d:02}T{h:02}"]
TIMES = ["", " {h:02}:{mi:02}", " {h:02}:{mi:02}:{s:02}", " {h:02}:{mi:02}:{s:02}.25", " {h12}:{mi:02} {half}", " {h12}{half}", "T{h:02}:{mi:02}"]


def mixed_texts(n=900):
    rng = random.Random(11)
    out = []
    for i in range(n):
        form = FORMS[i % len(FORMS)]
        time = "" if "{h" in form else TIMES[rng.randrange(len(TIMES))]
        if time.startswith("T") and not form.startswith("{y}-{m:02}-"):
            time = " {h:02}:{mi:02}"
        if form.startswith("{y}") and "h12" in time:   # stated departure: always year, month, day
            time = " {h:02}:{mi:02}"
        m, h = rng.randrange(1, 15), rng.randrange(24)
        low = 13 if "{s:02}" in form else 1             # stated departure, 14 digits
        month = NAMES[(m - 1) % 12]
        out.append((form + time).format(
            d=rng.randrange(low, 33), m=min(m, 12) if low > 1 else m, y=rng.randrange(1980, 2040), yy=rng.randrange(80, 100) if i % 2 else rng.randrange(1, 30),
            mon=month[:3], month=month, wd="Tue", h=h, h12=h % 12 or 12, half=("am", "pm", "AM", "PM")[rng.randrange(4)],
            mi=rng.randrange(60), s=rng.randrange(60)))
    return out


def test_parse_vectors(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(VECTORS)], "i int, s string")
    got = {r.i: r.p for r in df.select("i", parse_mixed_dates("s").alias("p")).collect()}
    for i, (s, want) in enumerate(VECTORS):
        assert got[i] == want, f"{s!r}: got {got[i]}, want {want}"


def test_mixed_texts_read_like_the_batch_loader(spark):
    texts = mixed_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r.i: r.p for r in with_mixed_dates(df, "s", "p").collect()}
    pivot = {r.i: r.p for r in df.select("i", parse_mixed_dates("s").alias("p")).collect()}
    assert got == pivot
    read = 0
    for i, s in enumerate(texts):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = pd.to_datetime(pd.Series([s]), format="mixed", dayfirst=True, errors="coerce")[0]
        want = None if pd.isna(want) else want.to_pydatetime()
        assert got[i] == want, f"{s!r}: got {got[i]}, want {want}"
        read += want is not None
    assert read > len(texts) / 2


def test_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("5/1/98",), ("5/1/01",), ("5/1/68",), ("5/1/69",)], "s string")
    years = [r.p.year for r in df.select(parse_mixed_dates("s").alias("p")).collect()]
    assert years == [1998, 2001, 2068, 1969]


def test_date_id(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date")
    assert df.select(date_id("d").alias("k")).first().k == 20240105


def test_parse_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("10-03-2024 02:30:00",)], "s string")
        got = df.select(parse_mixed_dates("s").alias("p")).first().p
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 3, 10, 2, 30)   # inside the DST gap there
