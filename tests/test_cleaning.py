import datetime as dt

from pyspark.sql import functions as F

from insights.functions import cleaning as C


def test_dirty_null_and_arrays(spark):
    df = spark.createDataFrame([("null",), ("",), (None,), ("2, 6",), ("4,x, 5",), (" 7 ",)], "c string")
    rows = df.select(C.is_dirty_null("c").alias("d"), C.csv_int_array("c").alias("a")).collect()
    assert [r.d for r in rows] == [True, True, True, False, False, False]
    assert [r.a for r in rows] == [[], [], [], [2, 6], [4, 5], [7]]


def test_number_from_text(spark):
    df = spark.createDataFrame([("23.4 km",), ("20km",), ("null",), ("32 minutes",), (None,)], "c string")
    vals = [r[0] for r in df.select(C.number_from_text("c").cast("double")).collect()]
    assert vals == [23.4, 20.0, None, 32.0, None]


def test_short_date_century_pivot(spark):
    df = spark.createDataFrame([("16/6/97",), ("1/1/01",), ("31/12/68",), ("1/1/69",), ("bad",)], "c string")
    got = [r[0] for r in df.select(C.parse_short_date("c")).collect()]
    assert got == [dt.date(1997, 6, 16), dt.date(2001, 1, 1), dt.date(2068, 12, 31), dt.date(1969, 1, 1), None]


def test_day_of_week(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert [r.n for r in df.select(C.dow_sunday0("d").alias("n")).collect()] == [5, 0]
