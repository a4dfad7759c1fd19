"""Column builders: the reference's scalar semantics and traps (SC-*, CLN-*, JSN-2, F-7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tramline.functions import text as T
from tramline.functions import timecols as C


def _one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_hour_of_text_time_matches_sqlite_rules(spark):
    vals = ["10:15:00", "24:30:00", "25:30:00", "9:05:00", "09:05", "ab", None, "23:61:00"]
    assert _one_col(spark, vals, C.hour_of_text_time) == [
        "10", "24", None, None, "09", None, None, None]


def test_service_seconds_keeps_past_midnight(spark):
    assert _one_col(spark, ["25:30:00", "00:00:01", "9:05:00", "x"], C.service_seconds) == [
        91800, 1, 32700, None]


def test_parse_compact_date_rejects_impossible_dates(spark):
    out = _one_col(spark, ["20240229", "20241301", "20240230", "2024011", None],
                   C.parse_compact_date)
    assert out == [dt.date(2024, 2, 29), None, None, None, None]


def test_week_bucket_truncates_toward_zero(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 26),), (dt.date(2023, 12, 25),),
                                (dt.date(2024, 1, 1),), (dt.date(2024, 1, 8),)], "d date")
    rows = df.select(C.week_bucket("d").alias("w"), C.week_bucket("d", floor=True).alias("f")
                     ).collect()
    # 6 days before the Monday epoch still land in week 0 (the reference's CAST).
    assert [(r.w, r.f) for r in rows] == [(0, -1), (-1, -1), (0, 0), (1, 1)]


def test_classify_frequency_thresholds(spark):
    assert _one_col(spark, [7, 5, 4, 2, 1, 0], C.classify_frequency, "int") == [
        "High Frequency", "High Frequency", "Medium Frequency", "Medium Frequency",
        "Low Frequency/Special", "Low Frequency/Special"]


@pytest.mark.parametrize("raw,expected", [
    ('{"low": -1, "high": 1, "unsigned": false}', (1 << 32) | 0xFFFFFFFF),
    ('{"low": 5}', 5),
    ('{"high": 2}', 2 << 32),
    ('{"low": -2147483648, "high": 0}', 2 ** 31),
    ("1700000000", 1700000000),
    ("0", 0),
    ("abc", None),
    (None, None),
])
def test_decode_long(spark, raw, expected):
    assert _one_col(spark, [raw], C.decode_long) == [expected]


def test_epoch_to_ts_zero_is_1970_not_null(spark):
    out = _one_col(spark, ["0", None, '{"low": 1700000000, "high": 0}'], C.epoch_to_ts)
    assert out == [dt.datetime(1970, 1, 1), None, dt.datetime(2023, 11, 14, 22, 13, 20)]


def test_clean_text_strips_tabs_blank_to_null_and_truncates(spark):
    vals = ["\t Gent-Sint-Pieters  ", "   ", "", None, "abc\n"]
    assert _one_col(spark, vals, lambda c: T.clean_text(c, 4)) == ["Gent", None, None, None, "abc"]


def test_clean_digits_only_plain_digits(spark):
    vals = [" 12 ", "-5", "3.0", "", "x1", "99999999999", None]
    assert _one_col(spark, vals, T.clean_digits) == [12, None, None, None, None, None, None]


def test_default_route_type_falsy_zero(spark):
    df = spark.createDataFrame([(0,), (None,), (3,)], "v int")
    got = [r[0] for r in df.select(T.default_route_type("v")).collect()]
    keep = [r[0] for r in df.select(T.default_route_type("v", falsy_zero=False)).collect()]
    assert got == [2, 2, 3] and keep == [0, 2, 3]


def test_cast_strict_raises_on_bad_text_and_lenient_does_not(spark):
    df = spark.createDataFrame([("12",), ("",), ("x",)], "v string")
    assert [r[0] for r in df.select(T.cast_lenient("v", "int")).collect()] == [12, None, None]
    with pytest.raises(Exception):
        df.select(T.cast_strict("v", "int")).collect()


@pytest.mark.parametrize("name,cat", [("IC-01", "IC"), ("S1", "S"), ("L 12", "L"),
                                      ("ICE", "Other"), ("SL", "Other"), ("P3", "Other"),
                                      ("S", "S"), (None, "Other")])
def test_train_category(spark, name, cat):
    assert _one_col(spark, [name], C.train_category) == [cat]


def test_on_time_flag_null_is_not_on_time(spark):
    # T-9: a missing delay must never count as on time (BI blank < 120 is true).
    assert _one_col(spark, [None, 119, 120, -300], C.on_time_flag, "int") == [
        None, True, False, True]


def test_like_ascii_ci_matches_sqlite(spark):
    vals = ["LIÈGE-Guillemins", "Liège-Guillemins", "Bruxelles-Central", None]
    out = _one_col(spark, vals, lambda c: T.like_ascii_ci(c, "%liège%"))
    assert out == [False, True, False, None]
    assert _one_col(spark, ["Bruxelles-Central"], lambda c: T.like_ascii_ci(c, "%BRUX%")) == [True]


def test_truncation_counts_characters_not_bytes(spark):
    # T-16: the loader truncates by characters (è is 2 bytes in UTF-8)
    assert _one_col(spark, ["Liège-Guillemins"], lambda c: T.clean_text(c, 4)) == ["Lièg"]


def test_local_hour_in_another_zone(spark):
    """SC-12: winter and summer time, and the night that has an hour twice."""
    from tramline.functions.timecols import local_hour
    df = spark.createDataFrame([("2024-01-05 08:00:00",), ("2024-07-05 08:00:00",), ("2024-10-27 00:30:00",),
                                ("2024-10-27 01:30:00",), (None,)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    assert [r[0] for r in df.select(local_hour("t", "Europe/Brussels")).collect()] == [9, 10, 2, 2, None]
