from datetime import datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from tradeglass.functions import dates, numeric, text


def test_floor_amount(spark):
    rows = spark.createDataFrame([(1234567899999,), (-1234567899999,), (0,), (None,)], "raw bigint")
    got = rows.select(numeric.floor_amount(F.col("raw"), 6), numeric.floor_amount(F.col("raw"), 2)).collect()
    assert [tuple(r) for r in got] == [
        (D("1.234567"), D("1.23")),
        (D("-1.234568"), D("-1.24")),
        (D("0.000000"), D("0.00")),
        (None, None),
    ]


def test_usd_value_rounds_half_up_exactly(spark):
    rows = spark.createDataFrame(
        [(D("1005000000000"), D("1")), (D("1004999999999"), D("1")), (None, D("1")), (D("5"), None)],
        "raw decimal(24,0), price decimal(20,10)",
    )
    got = [r[0] for r in rows.select(numeric.usd_value(F.col("raw"), F.col("price"))).collect()]
    assert got == [D("1.01"), D("1.00"), None, None]


def test_small_helpers(spark):
    row = spark.range(1).select(
        numeric.clamp_negative(F.lit(-1.5)),
        numeric.clamp_negative(F.lit(None).cast("double")),
        numeric.rounded_count(F.lit("123.45").cast("decimal(12,2)")),
        numeric.rounded_count(F.lit("123.50").cast("decimal(12,2)")),
        numeric.number_or_null(F.lit(float("nan"))),
        text.is_empty(F.lit("")),
        text.is_empty(F.lit(None).cast("string")),
        text.is_empty(F.lit("x")),
    ).first()
    assert tuple(row) == (0.0, None, 123, 124, None, True, True, False)


def test_market_split(spark):
    rows = spark.createDataFrame([("A-B",), ("A",), ("",), (None,)], "m string")
    got = rows.select(text.market_base(F.col("m")), text.market_quote(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("A", "B"), ("A", None), ("", None), (None, None)]


def test_stored_second(spark):
    rows = spark.createDataFrame([(1711027668215,), (1711027668500,), (1711027668499,)], "t bigint")
    got = [r[0] for r in rows.select(dates.stored_second(F.col("t"))).collect()]
    assert got == [datetime(2024, 3, 21, 13, 27, 48), datetime(2024, 3, 21, 13, 27, 49), datetime(2024, 3, 21, 13, 27, 48)]


def test_window_edges(spark):
    as_of = datetime(2024, 1, 30, 12)
    moments = {
        "2024-01-29 11:59:59": "previous",
        "2024-01-29 12:00:00": None,
        "2024-01-29 12:00:01": "current",
        "2024-01-28 12:00:00": None,
        "2024-01-28 12:00:01": "previous",
        "2024-01-30 12:00:00": "current",
        "2024-01-30 12:00:01": None,
    }
    rows = spark.createDataFrame([(m,) for m in moments], "m string").withColumn("ts", F.col("m").cast("timestamp"))
    ts = F.col("ts")
    label = F.when(dates.in_current(ts, as_of), "current").when(dates.in_previous(ts, as_of), "previous")
    assert {r[0]: r[1] for r in rows.select("m", label).collect()} == moments
