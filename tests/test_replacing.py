"""Old data survives a failed replace: catalog tables with and without a path, and exports."""

from __future__ import annotations

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from quaylake.plans import gold
from quaylake.sources import writers


@pytest.fixture
def table(spark):
    name = f"replaced_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def numbers(spark, n: int):
    return spark.range(n).withColumn("text", F.concat(F.lit("row, "), F.col("id").cast("string")))


def failing(df):
    """Some tasks write rows, then one fails."""
    return df.withColumn("text", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))


def tables(spark) -> set[str]:
    return {t.name for t in spark.catalog.listTables() if "replaced_" in t.name}


@pytest.mark.parametrize("replace", [writers.replace_table, writers.swap_table])
@pytest.mark.parametrize("with_path", [False, True])
def test_a_failed_replace_keeps_the_old_table(spark, folder, table, replace, with_path):
    path = f"{folder}/kept" if with_path else None
    replace(numbers(spark, 5), table, path)
    with pytest.raises(Exception, match="lost"):
        replace(failing(numbers(spark, 9)), table, path)
    assert spark.table(table).count() == 5
    assert tables(spark) == {table}
    replace(numbers(spark, 7), table, path)
    assert spark.table(table).count() == 7
    if with_path:
        assert len(os.listdir(path)) == 1  # the failed and the old build are gone


@pytest.mark.parametrize("with_path", [False, True])
def test_a_table_is_swapped_from_itself_again_and_again(spark, folder, table, with_path):
    path = f"{folder}/own" if with_path else None
    now = writers.swap_table(numbers(spark, 5), table, path)
    for _ in range(3):
        now = writers.swap_table(now.withColumn("id", F.col("id") * 2), table, path)
    assert sorted(r["id"] for r in now.collect()) == [0, 8, 16, 24, 32]
    assert sorted(r["id"] for r in spark.table(table).collect()) == [0, 8, 16, 24, 32]


def test_a_rename_that_fails_brings_the_old_table_back(spark, folder, table, monkeypatch):
    writers.swap_table(numbers(spark, 5), table, f"{folder}/t")
    plain = type(spark).sql

    def refused(self, text, *args, **kwargs):
        if "__new_" in text and "RENAME" in text:
            raise RuntimeError("refused")
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", refused)
    with pytest.raises(RuntimeError):
        writers.swap_table(numbers(spark, 8), table, f"{folder}/t")
    monkeypatch.undo()
    assert spark.table(table).count() == 5 and tables(spark) == {table}
    assert len(os.listdir(f"{folder}/t")) == 1


def test_the_gold_summary_is_rebuilt_under_one_path(spark, folder, table, monkeypatch):
    monkeypatch.setattr(gold, "staging", lambda spark, source, schema: numbers(spark, 4))
    monkeypatch.setattr(gold, "sales_summary", lambda frame, as_of: frame)
    for _ in range(2):
        assert gold.build_sales_summary(spark, table=table, path=f"{folder}/gold").count() == 4


@pytest.mark.parametrize("one_file", [False, True])
def test_a_failed_export_keeps_the_old_one(spark, folder, one_file):
    path = f"{folder}/export"
    writers.export_csv(numbers(spark, 5), path, one_file)
    with pytest.raises(Exception, match="lost"):
        writers.export_csv(failing(numbers(spark, 9)), path, one_file)
    assert spark.read.option("header", True).csv(path).count() == 5
    assert os.listdir(folder) == ["export"]
    writers.export_csv(numbers(spark, 2), path, one_file)
    assert spark.read.option("header", True).csv(path).count() == 2


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_one_file_is_what_one_task_would_write(spark, folder, rows):
    df = numbers(spark, rows).withColumn("quoted", F.lit('a "quoted"\nvalue')).withColumn("none", F.lit(None).cast("string"))
    df = df.repartition(6).orderBy(F.col("id").desc())
    writers.export_csv(df, f"{folder}/joined", one_file=True)
    df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{folder}/single")
    joined, single = (glob.glob(f"{folder}/{name}/part-*") for name in ("joined", "single"))
    assert len(joined) == len(single) == 1
    assert open(joined[0], "rb").read() == open(single[0], "rb").read()
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{folder}/joined").count() == rows
