"""Groups, rankings, profiles and listings against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from quaylake.operators import grouping, listing, profiling, ranking
from quaylake.operators.snapshots import newest_snapshots
from quaylake.plans.reports import DumpReport
from quaylake.session import new_folder


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def amounts(spark):
    data = [(1, "A", 10.0), (2, "B", None), (3, None, 5.0), (4, "A", 20.0), (5, "B", 30.0), (6, "C", 30.0)]
    return spark.createDataFrame(data, "id int, status string, amount double")


def test_null_keys_stay_in_sql_groups_only(amounts):
    wanted = {"n": "rows", "filled": "count", "total": "sum", "mean": "mean", "low": "min", "high": "max"}
    kept = rows(grouping.measure_by(amounts, "status", "amount", wanted, largest="n"))
    assert kept == [
        ("A", 2, 2, 30.0, 15.0, 10.0, 20.0), ("B", 2, 1, 30.0, 30.0, 30.0, 30.0),
        ("C", 1, 1, 30.0, 30.0, 30.0, 30.0), (None, 1, 1, 5.0, 5.0, 5.0, 5.0),
    ]
    assert rows(grouping.value_counts(amounts, "status")) == [("A", 2), ("B", 2), ("C", 1)]


def test_rankings_settle_ties(amounts):
    assert rows(ranking.top_rows(amounts, "amount", 2, ["id"]).select("id")) == [(5,), (6,)]
    top = ranking.top_groups(amounts, "status", "amount", {"total": "sum"}, "total", 2)
    assert rows(top) == [("A", 30.0), ("B", 30.0)]
    assert rows(ranking.sorted_ascending(amounts.select("status"), "status"))[-1] == (None,)
    assert [r[0] for r in rows(ranking.sorted_by_amount(amounts, "amount", ["id"]))] == [5, 6, 4, 1, 3, 2]


def test_summary_of_nothing(amounts):
    nothing = amounts.filter("id < 0")
    assert rows(grouping.match_summary(nothing, "status", "amount")) == [(0, None, 0, None)]
    assert rows(grouping.open_totals(nothing, "status", "amount")) == [(0, 0.0, 0)]


def test_open_totals(spark):
    df = spark.createDataFrame([("UNMATCHED", 2.0), ("UNMATCHED_MOVEMENT", 3.0), ("MATCHED", 4.0)], "status string, amount double")
    assert rows(grouping.open_totals(df, "status", "amount")) == [(1, 2.0, 2)]


def test_daily_series_puts_the_unknown_day_last(spark):
    df = spark.createDataFrame([("2024-01-02 10:00:00", 1.0), (None, 2.0), ("2024-01-01 00:00:00", 3.0)], "t string, amount double")
    got = rows(grouping.daily_series(df.select(F.col("t").cast("timestamp").alias("t"), "amount"), "t", "amount"))
    assert [(str(d), n, v) for d, n, v in got] == [("2024-01-01", 1, 3.0), ("2024-01-02", 1, 1.0), ("None", 1, 2.0)]


def test_profile(amounts):
    summary = profiling.dataset_summary(amounts).first()
    assert (summary["total_rows"], summary["total_columns"], summary["columns"]) == (6, 3, ["id", "status", "amount"])
    assert summary["null_counts"] == {"id": 0, "status": 1, "amount": 1}
    assert rows(profiling.null_counts(amounts)) == [("id", 0), ("status", 1), ("amount", 1)]
    assert rows(profiling.schema_listing(amounts)) == [("id", "int"), ("status", "string"), ("amount", "double")]


def test_distinct_values_are_listed_up_to_ten(spark):
    df = spark.createDataFrame([(str(i % 10), str(i % 11), None) for i in range(50)], "a string, b string, c string")
    assert sorted(rows(profiling.distinct_values(df))) == [
        ("a", 10, [str(i) for i in range(10)]), ("b", 11, None), ("c", 0, None),
    ]


def brute_quantile(values, share):
    place = (len(values) - 1) * share
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low if low == high else low + (high - low) * (place - math.floor(place))


def test_texts_are_no_shuffle_keys(spark, folder):
    """One scan and one deduplication, by hashes."""
    spark.createDataFrame([("x" * 50, "y")], "a string, b string").write.parquet(folder)
    pairs = profiling.hashed_values(spark.read.parquet(folder), ["a", "b"]).select("i", "hash").distinct()
    plan = pairs.groupBy("i").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "value" not in " ".join(line for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("slices, settled, missed", [(2, 0, False), (7, 5, False), (1000, 0, False), (1000, 0, True), (1000, 10_000, False)])
def test_quartiles_are_exact(spark, monkeypatch, slices, settled, missed):
    """Hot values, wide and infinite ranges, nulls and NaN, however fine the slices, with brackets that miss too."""
    monkeypatch.setattr(profiling, "SLICES", slices)
    monkeypatch.setattr(profiling, "SETTLED", settled)
    if missed:
        monkeypatch.setattr(profiling, "disjoint", lambda ends: ((ends[1], ends[1] + 1e-9), (1e300, 1e301)))
    draw = random.Random(7)
    third = [5.0 if draw.random() < 0.34 else draw.gauss(0, 100) for _ in range(2000)]
    wide = [draw.choice([-1e308, 1e308, float("inf"), draw.gauss(0, 1) * 10 ** draw.randint(-300, 300)]) for _ in range(2000)]
    gaps = [draw.choice([None, float("nan"), draw.random()]) for _ in range(2000)]
    near = [draw.choice([1.0, math.nextafter(1.0, 2), 5e-324, 0.0]) for _ in range(2000)]
    df = spark.createDataFrame(list(zip(third, wide, gaps, near)), "a double, b double, c double, d double")
    got = {r["column"]: r for r in profiling.describe(df).collect()}
    for name, column in zip("abcd", (third, wide, gaps, near)):
        kept = sorted(v for v in column if v is not None and not math.isnan(v))
        assert got[name]["count"] == len(kept)
        for quartile, share in profiling.QUARTILES.items():
            assert got[name][quartile] == brute_quantile(kept, share), (name, quartile)


@pytest.fixture
def scans(monkeypatch):
    """One entry per scan behind the first."""
    found, plain = [], profiling.narrowed

    def counted(numbers, ranges):
        found.extend([len(ranges)] if ranges else [])
        return plain(numbers, ranges)

    monkeypatch.setattr(profiling, "narrowed", counted)
    return found


def test_ordinary_values_take_three_scans(spark, scans):
    """Even, normal, skewed and mostly equal values, many more than are settled at once."""
    df = spark.range(0, 200_000, 1, 4).select(
        F.rand(1).alias("a"), F.randn(2).alias("b"), F.exp(3 * F.randn(3)).alias("c"),
        F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.rand(4) * 1000).alias("d"),
    )
    df.write.parquet(path := new_folder(spark, "ordinary"))
    df = spark.read.parquet(path)
    got = {r["column"]: r for r in profiling.describe(df).collect()}
    assert len(scans) == 2
    for name, column in df.toPandas().items():
        for quartile, share in profiling.QUARTILES.items():
            assert got[name][quartile] == brute_quantile(sorted(column), share)


def test_the_number_of_scans_does_not_depend_on_the_values(spark, monkeypatch, scans):
    """Values even over all exponents, even within one, and crowded: at most nine scans each."""
    draw = random.Random(9)
    monkeypatch.setattr(profiling, "SETTLED", 0)
    rows = [
        (math.ldexp(1 + draw.random(), draw.randint(-1070, 1020)) * draw.choice([1, -1]), draw.random(),
         1 + draw.randint(0, 2**30) * 2.0**-52)
        for _ in range(3000)
    ]
    got = {r["column"]: r for r in profiling.describe(spark.createDataFrame(rows, "a double, b double, c double")).collect()}
    for name, column in zip("abc", zip(*rows)):
        for quartile, share in profiling.QUARTILES.items():
            assert got[name][quartile] == brute_quantile(sorted(column), share)
    assert 1 + len(scans) <= 9


def test_description_of_short_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    got = {r["column"]: tuple(r)[1:] for r in profiling.describe(df).collect()}
    assert got["a"] == (2, 1.5, math.sqrt(0.5), 1.0, 1.25, 1.5, 1.75, 2.0)
    assert got["b"] == (0, None, None, None, None, None, None, None)


def test_newest_snapshots(spark):
    df = spark.createDataFrame([(f"2024010{d}_000000", i) for d in range(1, 9) for i in range(d)], "snapshot_ts string, i int")
    kept = {r["snapshot_ts"][:8] for r in newest_snapshots(df, keep=3).collect()}
    assert kept == {"20240106", "20240107", "20240108"}
    assert newest_snapshots(df, keep=30).count() == 36


LISTING = [
    ";",
    "; Archive created at 2024-01-01",
    "215; 1259 16400 TABLE public invoices owner",
    "216; 1259 16401 TABLE public invoice owner",
    "217; 1259 16402 TABLE public invoice owner",
    "218; 0 16400 TABLE DATA public invoices owner",
    "219; 1259 INDEX public invoices_invoice_idx owner",
    "220; 1259 INDEX public idx_invoice owner",
    "221; 1259 INDEX public invoice_invoice_x owner",
    "222; 2606 CONSTRAINT public invoice invoice_pkey owner",
    "223; 2606 FK CONSTRAINT public invoices invoices_customer_fk owner",
    "224; 2606 FK CONSTRAINT public other other_invoice owner",
    "short TABLE public",
    "TABLE public lonely",
    "",
]


def brute_mentions(lines, names):
    return {
        name: (
            sum(f"{name}_" in line and "INDEX" in line for line in lines),
            sum(name in line and "FK CONSTRAINT" in line for line in lines),
        )
        for name in names
    }


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(list(enumerate(LISTING)), "n int, value string")


def test_listing(lines):
    report = DumpReport(lines)
    assert rows(report.objects()) == [(5, 3, 3, 2)]
    assert rows(report.tables()) == [("invoice",), ("invoices",)]
    assert [r["n"] for r in report.header().collect()] == [0, 1]
    got = {r["name"]: (r["indexes"], r["foreign_keys"]) for r in report.mentions().collect()}
    assert got == brute_mentions(LISTING, ["invoice", "invoices"])


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_mentions_against_brute_force(spark, broadcast):
    """With and without broadcasts by the optimizer."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    draw = random.Random(11)
    names = sorted({"".join(draw.choice("ab_") for _ in range(draw.randint(1, 5))) for _ in range(40)} | {"zzzzzz"})
    texts = [
        draw.choice(["INDEX ", "FK CONSTRAINT ", "TABLE ", "INDEX FK CONSTRAINT "])
        + "".join(draw.choice("ab_ ") for _ in range(draw.randint(0, 30)))
        for _ in range(300)
    ]
    texts += ["INDEX aaaa_aaaa_"] * 150  # a third of the lines mention the same names
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    found = listing.mention_counts(lines, spark.createDataFrame([(n,) for n in names], "name string")).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["name"]: (r["indexes"], r["foreign_keys"]) for r in found} == brute_mentions(texts, names)


def test_a_line_offers_no_more_than_its_length(spark):
    texts = ["", "ab", "abc" * 14, "x" * 43]
    lines = spark.createDataFrame(list(enumerate(texts)), "line long, value string")
    for sizes in ((1,), (2, 8), (1, 4, 16)):
        got = sorted((r["line"], r["place"]) for r in listing.grams(lines, sizes).collect())
        assert got == sorted((i, p + 1) for i, t in enumerate(texts) for k in sizes for p in range(len(t) - k + 1))


def test_names_with_one_beginning_meet_few_lines(spark):
    """Two thousand names that differ in their ends, and one of a single letter."""
    texts = [f"INDEX table_number_{i % 2000}_key" for i in range(4000)]
    names = [f"table_number_{i}" for i in range(2000)] + ["t", "nowhere_at_all", "é" * 20]
    lines = spark.createDataFrame(list(enumerate(texts)), "line long, value string")
    given = spark.createDataFrame([(n,) for n in names], "name string")
    mentions = sum(name in text for name in names for text in texts)
    assert listing.met(lines, given).count() <= 2 * mentions + len(texts)
    got = {r["name"]: (r["indexes"], r["foreign_keys"]) for r in listing.mention_counts(lines, given).collect()}
    assert got == brute_mentions(texts, names)


def test_all_comment_lines_are_shown(spark):
    lines = spark.createDataFrame([(n, ";" if n % 2 else "x") for n in range(100)], "n int, value string")
    assert [r["n"] for r in listing.header(lines, "n").collect()] == list(range(1, 100, 2))


def test_mentions_of_no_names(spark, lines):
    none = spark.createDataFrame([], "name string")
    assert listing.mention_counts(lines, none).count() == 0
