"""Snapshots that go, measures taken while writing, files by ranges, measures merged by day."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaylake.operators import partials
from quaylake.operators.profiling import dataset_summary
from quaylake.plans import bronze, daily
from quaylake.plans.reports import ConsoleReport, Dashboard
from quaylake.sources import writers

START = datetime(2024, 2, 1)


def rows(df):
    return [tuple(r) for r in df.collect()]


def labels(folder: str) -> list[str]:
    return sorted(os.listdir(f"{folder}/history"))


def label(hour: int) -> str:
    return f"snapshot_ts=20240201_{hour:02d}0000"


def test_a_sixth_snapshot_leaves_five_folders(spark, folder):
    for hour in range(6):
        bronze.database_snapshot(spark.range(hour + 1), folder, START.replace(hour=hour))
    assert labels(folder) == [label(h) for h in range(1, 6)]
    bronze.database_snapshot(spark.range(9), folder, START.replace(hour=9), keep=None)
    assert labels(folder) == [label(h) for h in (1, 2, 3, 4, 5, 9)]
    bronze.database_snapshot(spark.range(0), folder, START.replace(hour=11))
    assert len(labels(folder)) == 6  # no rows: nothing is written, nothing goes
    with pytest.raises(ValueError):
        writers.delete_old_snapshots(spark, folder, 0)
    assert writers.delete_old_snapshots(spark, f"{folder}/none", 3) == []


@pytest.mark.parametrize("step", ["moved", "removed"])
def test_a_removal_that_breaks_off_leaves_a_readable_history(spark, folder, monkeypatch, step):
    for hour in range(6):
        writers.write_snapshot(spark.range(hour + 1), folder, START.replace(hour=hour))
    plain = getattr(writers, step)

    def broken(spark, path, *rest):
        if label(1) in path or path.rsplit("/", 1)[1].startswith("_removed-20240201_01"):
            raise OSError("gone away")
        return plain(spark, path, *rest)

    monkeypatch.setattr(writers, step, broken)
    with pytest.raises(OSError):
        writers.delete_old_snapshots(spark, folder, 3)
    counts = dict(rows(writers.history(spark, folder).groupBy("snapshot_ts").count()))
    assert all(counts[f"20240201_0{h}0000"] == h + 1 for h in (3, 4, 5))
    assert all(n == int(at[10]) + 1 for at, n in counts.items())  # whatever is still there is whole
    monkeypatch.undo()
    writers.delete_old_snapshots(spark, folder, 3)
    assert labels(folder) == [label(h) for h in (3, 4, 5)]


def test_source_and_snapshot_are_read_once(spark, folder, file_scans):
    spark.range(1000).withColumn("note", F.when(F.col("id") % 3 == 0, "x")).write.parquet(f"{folder}/source")
    source = spark.read.parquet(f"{folder}/source")
    file_scans()
    _, summary = bronze.database_snapshot(source, f"{folder}/kept", START)
    assert file_scans() == [1000, 1000]  # the source, and the snapshot that is copied to latest
    assert rows(summary) == rows(dataset_summary(source)) and summary.columns == dataset_summary(source).columns
    file_scans()
    assert writers.land(source, f"{folder}/landed", START) and not writers.land(source.where("id < 0"), f"{folder}/landed")
    assert sum(file_scans()) == 1000


@pytest.mark.parametrize("odd", ["total_rows", "n0", "rows", "a.b", "a`b"])
def test_measured_columns_may_have_any_name(spark, folder, odd):
    df = spark.createDataFrame([(1, None), (2, "x")], f"id int, `{odd.replace('`', '``')}` string")
    _, summary = bronze.database_snapshot(df, folder, START)
    assert summary.first()["null_counts"] == {"id": 0, odd: 1} and summary.first()["total_rows"] == 2


def test_a_narrow_range_reads_few_rows(spark, folder, file_scans):
    df = spark.range(0, 40_000, 1, 4).select(
        F.rand(3).alias("amount"), (F.col("id") * 2).cast("string").alias("code"), F.lit("x" * 20).alias("pad")
    )
    plain = writers.overwrite_parquet(df, f"{folder}/plain")
    ordered = writers.overwrite_ordered(df, f"{folder}/ordered", ["amount"], equal=["code"], files=20)
    assert sorted(rows(ordered)) == sorted(rows(plain))
    file_scans()
    counts, read = [], []
    for table in (plain, ordered):
        counts.append(table.where("amount BETWEEN 0.5 AND 0.51").agg(F.count("pad")).first()[0])
        read.append(sum(file_scans()))
    assert counts[0] == counts[1] and read[1] <= 0.15 * 40_000 < read[0]
    assert ordered.where("code = '333'").agg(F.count("pad")).first()[0] == 0  # between least and largest, but odd
    assert sum(file_scans()) <= 0.15 * 40_000
    assert ordered.where("code = '334'").agg(F.count("pad")).first()[0] == 1


def test_equal_rows_are_dealt_to_several_files(spark, folder):
    df = spark.range(0, 30_000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("a.b"))
    writers.overwrite_ordered(df, f"{folder}/hot", ["a.b"], files=8)
    hot = spark.read.parquet(f"{folder}/hot")
    sizes = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 8_000
    assert sorted(rows(hot)) == sorted(rows(df))


@pytest.fixture
def reconciled(spark):
    day = F.date_add(F.lit(START.date()), (F.col("id") % 5).cast("int"))
    return spark.range(500).select(
        "id", F.when(F.col("id") % 3 == 0, "MATCHED").when(F.col("id") % 3 == 1, "UNMATCHED").alias("status"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("s"), F.col("id") % 23)).alias("supplier"),
        F.when(F.col("id") % 7 > 0, (F.col("id") * 3 % 101).cast("double")).alias("amount"),
        F.when(F.col("id") % 11 > 0, F.date_add(F.lit(START.date()), (F.col("id") % 9).cast("int")).cast("timestamp")).alias("created_at"),
        day.cast("string").alias("_ingestion_date"),
    )


def test_merged_days_equal_all_rows(spark, folder, reconciled, file_scans):
    reconciled.write.partitionBy("_ingestion_date").parquet(f"{folder}/bronze")
    table = spark.read.option("basePath", f"{folder}/bronze").parquet(f"{folder}/bronze").withColumn(
        "_ingestion_date", F.col("_ingestion_date").cast("string")
    )
    days = [date(2024, 2, 1) + timedelta(days=i) for i in range(5)]
    for day in days[:4]:
        daily.store_day(table, f"{folder}/days", day)
    file_scans()
    daily.store_day(table, f"{folder}/days", days[4])
    assert file_scans() == [100]  # only the new day
    daily.store_day(table, f"{folder}/days", days[4])  # again: it takes its own place
    merged, whole = daily.MergedDashboard(daily.stored_days(spark, f"{folder}/days")), Dashboard(reconciled)
    assert rows(merged.status()) == rows(whole.status())
    assert rows(merged.status_value()) == rows(ConsoleReport(reconciled).status_value())
    assert rows(merged.top_suppliers()) == rows(whole.top_suppliers())
    assert rows(merged.daily()) == rows(whole.daily())
    assert rows(merged.summary()) == rows(whole.summary())
    file_scans()
    merged.status().collect()
    assert sum(file_scans()) < 250  # partial rows, where the table has 500 rows


def test_a_day_without_rows(spark, folder, reconciled):
    assert daily.store_day(reconciled, folder, date(2020, 1, 1)).count() == 0
    merged = daily.MergedDashboard(daily.stored_days(spark, folder))
    assert rows(merged.summary()) == [(0, None, 0, None)] and rows(merged.status()) == []


def test_all_measures_merge(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", None, 3), (None, 4, 4), ("b", None, 5)], "k string, v int, w int")
    wanted = {"n": "rows", "filled": "count", "total": "sum", "mean": "mean", "low": "min", "high": "max"}
    halves = [partials.partial_measures(df.where(c), {"k": ["k"], "w": ["w"]}, "v") for c in ("w < 4", "w >= 4")]
    got = partials.merged_by(halves[0].unionByName(halves[1]), "k", "k", wanted)
    assert sorted(rows(got), key=repr) == [
        ("a", 2, 1, 1, 1.0, 1, 1), ("b", 1, 0, None, None, None, None), (None, 1, 1, 4, 4.0, 4, 4),
    ]
    with pytest.raises(ValueError):
        partials.partial_measures(df.withColumnRenamed("k", "partial_sum"), {"k": ["partial_sum"]}, "v")
