import datetime

import pytest
from pyspark.sql import functions as F

from matchlake.functions import text
from matchlake.functions.numbers import half_up, ratio


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Delhi Daredevils", "Delhi Capitals"),
        ("Kings XI Punjab", "Punjab Kings"),
        ("Rising Pune Supergiant", "Rising Pune Supergiants"),
        (" Royal Challengers Bangalore ", "Royal Challengers Bengaluru"),
        ("Southern Stars", "Southern Stars"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_name(spark, raw, expected):
    assert one(spark, text.canonical_name(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "season, date, expected",
    [("2024", None, "2024"), (None, "2018-04-07", "2018"), ("2020/21", "2020-09-19", "2020"), ("", "2019-01-01", "2019"), (None, None, None)],
)
def test_season(spark, season, date, expected):
    assert one(spark, text.season_of(F.lit(season).cast("string"), F.lit(date).cast("string"))) == expected


def test_iso_parse(spark):
    expected = datetime.datetime(2026, 1, 1, 12, 0, 0, 250000)
    assert one(spark, text.parse_iso(F.lit("2026-01-01T12:00:00.250000Z"))) == expected
    assert one(spark, text.parse_iso(F.lit("soon"))) is None


def test_rounding_is_half_up_and_exact(spark):
    assert one(spark, half_up(F.lit("0.125").cast("decimal(10,3)"), 2)) == 0.13
    assert one(spark, ratio(F.lit(74), F.lit(85), 2)) == 0.87
    assert one(spark, ratio(F.lit(1), F.lit(0), 2)) is None
    # more than ten million cases of many days each must not overflow
    assert one(spark, ratio(F.lit(10**16), F.lit(10**10), 2)) == 1_000_000.0
