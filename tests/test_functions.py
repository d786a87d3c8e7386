"""Casts, text, time and measures."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from quaylake.functions import casting, measures, text, time


def values(spark, kind, given, expression):
    df = spark.createDataFrame([(v,) for v in given], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x")).alias("y")).collect()]


def test_to_number(spark):
    given = ["12", " 1.5 ", "-3e2", "", "x", "12d", "3.5F ", "Infinity", "inf", None, "1,5"]
    want = [12.0, 1.5, -300.0, None, None, None, None, float("inf"), float("inf"), None, None]
    assert values(spark, "string", given, casting.to_number) == want


def test_to_timestamp(spark):
    given = ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05.5", "2024-01-02T03:04:05+02:00", "2024-02-30", "x", "", None]
    want = [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 500000), datetime(2024, 1, 2, 1, 4, 5),
        None, None, None, None,
    ]
    got = values(spark, "string", given, lambda c: casting.to_timestamp_or_null(c).cast("timestamp_ntz"))
    assert got == want


def test_mixed_formats_are_read_row_by_row(spark):
    got = values(spark, "string", ["2024-01-02", "02/01/2024", "2/2"], lambda c: casting.to_date_or_null(c, ["dd/MM/yyyy"]))
    assert got == [date(2024, 1, 2), date(2024, 1, 2), None]


@pytest.mark.parametrize("kind, bad", [("int", "1.5x"), ("date", "2024-13-01"), ("decimal(18,6)", "abc"), ("timestamp", "soon")])
def test_strict_casts_fail(spark, kind, bad):
    df = spark.createDataFrame([(bad,)], "x string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(*casting.strict_casts({"x": kind})).collect()


def test_whole_numbers(spark):
    assert values(spark, "double", [2.7, -2.7, 2.5], casting.whole_number) == [2, -2, 2]
    assert values(spark, "double", [2.7, -2.7, 2.5], lambda c: casting.whole_number(c, rounded=True)) == [3, -3, 3]


def test_clean_text(spark):
    assert values(spark, "string", [" a b ", "   ", "", None], text.clean_text) == ["a b", None, None, None]


def test_tokens_from_the_end(spark):
    given = ["a b c d", "  a\t b  c ", "one", "", None]
    assert values(spark, "string", given, lambda c: text.token_from_end(c, 2, 3)) == ["c", "b", None, None, None]
    assert values(spark, "string", given, lambda c: text.token_from_end(c, 2)) == ["c", "b", None, None, None]


def test_prefix_category(spark):
    rules = [("data-", "given"), ("df_", "made"), ("data-x", "never")]
    got = values(spark, "string", ["data-x1", "df_2", "x"], lambda c: text.prefix_category(c, rules, "other"))
    assert got == ["given", "made", "other"]


def test_formats(spark):
    assert values(spark, "double", [1234567.125, 0.5, None], text.grouped_digits) == ["1,234,567.12", "0.50", None]
    assert values(spark, "string", ["abc", "abcdef"], lambda c: text.left_aligned(c, 5)) == ["abc  ", "abcdef"]
    assert values(spark, "int", [7, 123456], lambda c: text.right_aligned(c, 3)) == ["  7", "123456"]


def test_iso_text_drops_fraction_and_offset(spark):
    given = ["2024-01-02T03:04:05.678+05:00", "2024-01-02T03:04:05", "2024-01-02 03:04:05"]
    got = values(spark, "string", given, lambda c: time.iso_to_timestamp(c).cast("timestamp_ntz"))
    assert got == [datetime(2024, 1, 2, 3, 4, 5)] * 3


def test_instants(spark):
    assert time.utc_instant(datetime(2024, 1, 2)).tzinfo is timezone.utc
    row = spark.range(1).select(
        time.processing_time(datetime(2024, 1, 2, 3)).cast("string").alias("t"),
        time.reference_date(date(2024, 1, 2)).alias("d"),
        (time.processing_time() >= F.current_timestamp()).alias("now"),
        (time.reference_date() == F.current_date()).alias("today"),
        time.snapshot_label(F.lit("2024-01-31 23:59:59").cast("timestamp")).alias("label"),
    ).first()
    assert tuple(row) == ("2024-01-02 03:00:00", date(2024, 1, 2), True, True, "20240131_235959")


def test_percentage_and_units(spark):
    row = spark.range(1).select(
        F.round(measures.percentage(F.lit(332), F.lit(451)), 3),
        measures.percentage(F.lit(1), F.lit(0)),
        measures.kilobytes(F.lit(2048)),
        measures.megabytes(F.lit(1048576)),
    ).first()
    assert tuple(row) == (73.614, None, 2.0, 1.0)
