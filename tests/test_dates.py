import datetime as dt

from pyspark.sql import functions as F

from newsflow.functions import dates as D


def parse(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", fn(F.col("x")).alias("t")).collect()
    return [r["t"] for r in sorted(rows, key=lambda r: r["i"])]


def test_strict_golden(spark):
    got = parse(spark, D.parse_strict_dmy_hm,
                ["12/09/2023 à 10:30", "1/9/2023 à 7:05", "31/02/2023 à 10:00", "12/09/2023 À 10:30",
                 "12/09/2023 à 10:30 extra", "12/09/23 à 10:30", None])
    assert got == [dt.datetime(2023, 9, 12, 10, 30), dt.datetime(2023, 9, 1, 7, 5), None, None, None, None, None]


def test_free_form(spark):
    got = parse(spark, D.parse_free,
                ["12 septembre 2023 à 10:30", "1er mars 2024", "١٢ سبتمبر ٢٠٢٣", "3 جويلية 2022 - 08:15",
                 "September 12, 2023 10:30", "12/09/2023 10:30", "2023-09-12 10:30:05.5",
                 "il y a 2 heures", "31 février 2023", ""])
    assert got == [dt.datetime(2023, 9, 12, 10, 30), dt.datetime(2024, 3, 1), dt.datetime(2023, 9, 12),
                   dt.datetime(2022, 7, 3, 8, 15), dt.datetime(2023, 9, 12, 10, 30),
                   dt.datetime(2023, 9, 12, 10, 30), dt.datetime(2023, 9, 12, 10, 30, 5, 500000),
                   None, None, None]


def test_usual_spellings(spark):
    got = parse(spark, D.parse_free,
                ["mardi 12 septembre 2023", "الثلاثاء، ١٢ سبتمبر ٢٠٢٣", "September 12, 2023 3:30 PM", "5 avril 2023 10h", "12 اكتوبر 2023",
                 "Tuesday, September 12, 2023 12:05 a.m.", "12/09/2023 12:05 pm", "September 12, 2023 13:30 PM", "الاربعاء 3 ابريل 2024 8:05", "5 avril 2023 10h30"])
    d = dt.datetime
    assert got == [d(2023, 9, 12), d(2023, 9, 12), d(2023, 9, 12, 15, 30), d(2023, 4, 5, 10), d(2023, 10, 12),
                   d(2023, 9, 12, 0, 5), d(2023, 9, 12, 12, 5), None, d(2024, 4, 3, 8, 5), d(2023, 4, 5, 10, 30)]


def test_iso_hint_first(spark):
    got = parse(spark, D.parse_iso_or_free, ["2023-09-01 10:30:00.123", "01/02/2023 10:00"])
    assert got == [dt.datetime(2023, 9, 1, 10, 30, 0, 123000), dt.datetime(2023, 2, 1, 10, 0)]


def test_render_like_python_str(spark):
    vals = [dt.datetime(2023, 9, 1, 10, 30, 0, 123000), dt.datetime(2023, 9, 1, 10, 30)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r[0] for r in df.select(D.render_ts(F.col("t"))).collect()]
    assert got == [str(v) for v in vals] == ["2023-09-01 10:30:00.123000", "2023-09-01 10:30:00"]


def test_month_table_has_maghreb_names():
    assert D.MONTHS["جانفي"] == 1 and D.MONTHS["أوت"] == 8 and D.MONTHS["aout"] == 8 and D.MONTHS["sept"] == 9


def test_zoned_iso_converted_to_utc(spark):
    got = parse(spark, D.parse_iso_or_free,
                ["2023-09-01T10:30:00+01:00", "2023-09-01 10:30:00.250-0230", "2023-09-01T23:45Z",
                 "2023-09-01 10:30:00.123"])
    assert got == [dt.datetime(2023, 9, 1, 9, 30), dt.datetime(2023, 9, 1, 13, 0, 0, 250000),
                   dt.datetime(2023, 9, 1, 23, 45), dt.datetime(2023, 9, 1, 10, 30, 0, 123000)]


def test_iso_with_t_separator(spark):
    assert parse(spark, D.parse_free, ["2023-09-01T10:30"]) == [dt.datetime(2023, 9, 1, 10, 30)]
