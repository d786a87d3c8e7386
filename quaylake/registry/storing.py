"""Readers and writers: what is written to the shared folder is read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.operators.snapshots import newest_snapshots
from quaylake.plans import bronze, daily, gold
from quaylake.registry.base import query, rounded, table
from quaylake.registry.inputs import LISTING_SQL, RECONCILIATION_SQL, landed, listing_lines, reconciliation
from quaylake.operators.grouping import within
from quaylake.operators.ranking import sorted_by_amount
from quaylake.plans.reports import ConsoleReport, RangeStudy, SliceReport
from quaylake.sources import readers, writers
from quaylake.session import file_system, moved, new_folder

NOON = datetime(2024, 2, 1, 12, 0, 0)
LATER = datetime(2024, 2, 1, 18, 30, 0)


def new_table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def dropped(df: DataFrame, *tables: str) -> DataFrame:
    """The frame without the names it was read by: its files stay until the rows have been read."""
    for name in tables:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return df


def customers_with_null_text(spark, folder):
    """The segment of some customers is the text NULL, and that of others is missing."""
    nation = F.col("c_nationkey")
    segment = F.when(nation == 0, "NULL").when(nation != 1, F.concat("c_mktsegment", F.lit(' "x", '), nation))
    return table(spark, folder, "customer").select("c_custkey", segment.alias("segment"), "c_acctbal")


CUSTOMER_CSV = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, CASE WHEN c_nationkey = 0 THEN {null} WHEN c_nationkey <> 1 THEN c_mktsegment || ' "x", ' || c_nationkey END AS segment,
       c_acctbal FROM customer"""


def written_csv(spark, folder):
    path = new_folder(spark, "customers")
    writers.export_csv(customers_with_null_text(spark, folder), path)
    return path


@query("csv_null_text_kept", "A6 B9", CUSTOMER_CSV.format(null="'NULL'"))
def csv_null_text_kept(spark, folder):
    return readers.csv_table(spark, written_csv(spark, folder))


@query("csv_null_text_read", "A7", CUSTOMER_CSV.format(null="NULL"))
def csv_null_text_read(spark, folder):
    return readers.csv_table(spark, written_csv(spark, folder), readers.NULL_TEXT)


@query("csv_folder_report", "A8", "SELECT count(*) AS rows, 's_suppkey, s_name, s_nationkey' AS columns FROM supplier")
def csv_folder_report(spark, folder):
    path = new_folder(spark, "suppliers")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    writers.export_csv(suppliers.repartition(8, "s_suppkey"), path)
    report = readers.csv_folder(spark, path).report()
    return report.groupBy("columns").agg(F.sum("rows").alias("rows"))


FILES = {"data-1.csv": 0, "df_2.csv": 1, "other.csv": 2}


def written_files(spark, folder) -> str:
    """Three files of known names and lengths: the names of a third of the customers each."""
    target = new_folder(spark, "files")
    for name, rest in FILES.items():
        part = new_folder(spark, "part")
        names = table(spark, folder, "customer").where(F.col("c_custkey") % 3 == rest).select("c_name")
        names.coalesce(1).write.text(part)
        files, place = file_system(spark, part)
        source = next(f.getPath() for f in files.listStatus(place) if f.getPath().getName().startswith("part-"))
        moved(spark, source.toString(), f"{target}/{name}")
    return target


def files_sql(of: str) -> str:
    return " UNION ALL ".join(of.format(name=n, rest=r, kind={0: "CSV Original", 1: "DataFrame Exportado"}.get(r, "Outro")) for n, r in FILES.items())


@query("file_inventory", "A11", files_sql("""
SELECT '{kind}' AS kind, '{name}' AS file, round(sum(strlen(c_name) + 1) / 1024.0, 1)::DOUBLE AS size_kb FROM customer WHERE c_custkey % 3 = {rest}"""))
def file_inventory(spark, folder):
    return readers.file_inventory(spark, written_files(spark, folder))


@query("expected_files", "A11", files_sql("""
SELECT '{name}' AS file, TRUE AS "exists", round(sum(strlen(c_name) + 1) / 1024.0, 1)::DOUBLE AS size_kb FROM customer WHERE c_custkey % 3 = {rest}""")
 + " UNION ALL SELECT 'gone.html', FALSE, NULL")
def expected_files(spark, folder):
    path = written_files(spark, folder)
    return readers.expected_files(spark, path, [*FILES, "gone.html"]).select("file", "exists", "size_kb")


@query("csv_line_breaks", "A6 A7 B9", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name || chr(10) || 'a "b", c' AS note,
       CASE WHEN p_size % 4 = 3 THEN p_size END AS size FROM part""")
def csv_line_breaks(spark, folder):
    """Line breaks, quotes and commas inside fields, and three spellings of a missing number."""
    size = F.col("p_size")
    missing = F.when(size % 4 == 0, "N/A").when(size % 4 == 1, "None").when(size % 4 == 2, "nan").otherwise(size.cast("string"))
    rows = table(spark, folder, "part").select(
        "p_partkey", F.concat("p_name", F.lit('\na "b", c')).alias("note"), missing.alias("size")
    )
    path = new_folder(spark, "notes")
    writers.export_csv(rows, path)
    return readers.csv_table(spark, path, readers.MISSING_TEXTS, multi_line=True).withColumn("size", F.col("size").cast("int"))


@query("parquet_scan", "A9 C10", "SELECT * FROM orders")
def parquet_scan(spark, folder):
    return readers.parquet_table(spark, f"{folder}/orders.parquet").select("*")


@query("named_source", "A10 B6", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def named_source(spark, folder):
    name = new_table("silver_supplier")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    writers.replace_table(suppliers, name, new_folder(spark, name))
    return dropped(readers.named_table(spark, spark.catalog.currentDatabase(), name), name)


@query("text_listing", "A12", LISTING_SQL + "SELECT value FROM lines")
def text_listing(spark, folder):
    path = new_folder(spark, "listing")
    listing_lines(spark, folder).select("value").write.text(path)
    return readers.text_lines(spark, path)


@query("overwritten_parquet", "B1", "SELECT o_orderkey, o_totalprice FROM orders")
def overwritten_parquet(spark, folder):
    path = new_folder(spark, "overwritten")
    writers.overwrite_parquet(table(spark, folder, "supplier"), path)
    return writers.overwrite_parquet(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), path)


@query("stamped_events", "B2", """
SELECT event_id, '2024-02-01T12:00:00+00:00' AS _ingestion_ts_utc, '2024-02-01' AS _ingestion_date FROM events""")
def stamped_events(spark, folder):
    return writers.stamped(table(spark, folder, "events").select("event_id"), NOON)


@query("guarded_write", "B5", """
SELECT s_suppkey, s_name, '2024-02-01T12:00:00+00:00' AS _ingestion_ts_utc, '2024-02-01' AS _ingestion_date FROM supplier""")
def guarded_write(spark, folder):
    path = new_folder(spark, "guarded")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    writers.land(suppliers, path, NOON)
    writers.land(suppliers.filter(F.col("s_suppkey").isNull()), path, LATER)
    return readers.parquet_table(spark, path)


SNAPSHOT_HOURS = range(12, 19)


@query("database_snapshots", "B3 B4 M8 F14", " UNION ALL ".join(
    f"SELECT '20240201_{h}0000' AS snapshot_ts, c_custkey, {'c_name' if h > 15 else 'NULL'} AS added, 'history' AS part "
    f"FROM customer WHERE c_custkey % 20 >= {h}" for h in SNAPSHOT_HOURS[-5:]) + """
 UNION ALL SELECT NULL, c_custkey, c_name, 'latest' FROM customer WHERE c_custkey % 20 >= 18""")
def database_snapshots(spark, folder):
    """Seven snapshots, the newest with one more column; an empty one leaves no trace."""
    target = new_folder(spark, "snapshots")
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("added"))
    for hour in SNAPSHOT_HOURS:
        rows = customers.where(F.col("c_custkey") % 20 >= hour)
        bronze.database_snapshot(rows if hour > 15 else rows.drop("added"), target, NOON.replace(hour=hour))
    bronze.database_snapshot(customers.filter(F.col("c_custkey").isNull()), target, LATER)
    kept = bronze.retained_history(spark, target).select("snapshot_ts", "c_custkey", "added", F.lit("history").alias("part"))
    latest = readers.parquet_table(spark, f"{target}/latest").select("c_custkey", "added", F.lit("latest").alias("part"))
    return kept.unionByName(latest, allowMissingColumns=True)


@query("landed_in_many_pages", "A2 M1 B5", """
SELECT CAST(o_orderkey AS VARCHAR) AS "ID_VEICULO", o_orderpriority AS "VEICULO", '2024-02-01' AS _ingestion_date FROM orders""")
def landed_in_many_pages(spark, folder):
    """More than a thousand full pages from the second scale on."""
    key = F.col("o_orderkey")
    record = F.to_json(F.struct(key.alias("id"), F.col("o_orderpriority").alias("code")))
    pages = landed(table(spark, folder, "orders"), "o_orderkey", record, (F.floor(key / 10) + 1).cast("int"))
    path = new_folder(spark, "vehicles")
    bronze.land_endpoint(pages, "vehicles", path, NOON, page_size=10)
    return readers.parquet_table(spark, path).select("ID_VEICULO", "VEICULO", "_ingestion_date")


@query("newest_snapshots", "B4", """
SELECT event_id, snapshot_ts FROM (
  SELECT event_id, strftime(ts, '%Y%m%d') AS snapshot_ts, dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) AS age FROM events)
WHERE age <= 5""")
def newest_event_snapshots(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("snapshot_ts"))
    return newest_snapshots(events)


@query("table_as_select", "B6 M12", RECONCILIATION_SQL + """
SELECT status, round(sum(amount), 2) AS total, round(avg(amount), 2) AS media FROM conciliacoes GROUP BY status""")
def table_as_select(spark, folder):
    name = new_table("conciliacoes")
    stored = writers.replace_table(reconciliation(spark, folder), name, new_folder(spark, name))
    return dropped(rounded(ConsoleReport(stored).status_value(), "total", "media"), name)


@query("view_of_query", "B7", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def view_of_query(spark, folder):
    orders = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderstatus")
    return writers.replace_view(orders, new_table("open_orders"))


@query("swapped_table", "B8", "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders")
def swapped_table(spark, folder):
    """The second build reads the table it replaces."""
    name = new_table("prices")
    prices = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("doubled"))
    first = writers.swap_table(prices, name, new_folder(spark, name))
    second = writers.swap_table(first.withColumn("doubled", F.col("doubled") * 2), name, new_folder(spark, name))
    return dropped(second, name)


@query("gold_sales_summary", "M11 A10 B7 B8 F17", """
SELECT DATE '2024-02-01' AS data_referencia, count(*) AS qtd_linhas_pcnfsaid FROM orders""")
def gold_sales_summary(spark, folder):
    name = new_table("sales")
    writers.replace_table(table(spark, folder, "orders"), name, new_folder(spark, name))
    staged = gold.staging(spark, name, spark.catalog.currentDatabase())
    summary = new_table(gold.SALES_SUMMARY)
    built = writers.swap_table(gold.sales_summary(staged, NOON.date()), summary, new_folder(spark, summary))
    return dropped(built, name, summary)


@query("staging_views", "A10 B7 M11", """
SELECT 'sales' AS source, count(*) AS lines FROM orders UNION ALL SELECT 'users', count(*) FROM customer""")
def staging_views(spark, folder):
    """Both staging views, read by another session."""
    schema = spark.catalog.currentDatabase()
    sources = {gold.SALES_SOURCE: "orders", gold.USERS_SOURCE: "customer"}
    for source, name in sources.items():
        writers.replace_table(table(spark, folder, name), source, new_folder(spark, source))
    gold.staging_views(spark, schema)
    other = spark.newSession()
    lines = [other.table(f"`{schema}`.`stg_{source}`").count() for source in sources]
    for source in sources:
        spark.sql(f"DROP VIEW stg_{source}")
        spark.sql(f"DROP TABLE {source}")
    return spark.createDataFrame(list(zip(("sales", "users"), lines)), "source string, lines bigint")


@query("exported_slice", "B9 A7 F8 M14", RECONCILIATION_SQL + """
SELECT source, count(amount) AS count, round(sum(amount), 2) AS sum FROM conciliacoes
WHERE amount BETWEEN 100000 AND 200000 GROUP BY source""")
def exported_slice(spark, folder):
    path = new_folder(spark, "slice")
    part = within(reconciliation(spark, folder), "amount", 100000, 200000)
    writers.export_csv(sorted_by_amount(part, "amount", ["id"]), path)
    exported = readers.csv_table(spark, path, readers.NULL_TEXT)
    return rounded(SliceReport(exported).source(), "sum")


@query("snapshots_kept", "B4 F14 M8", " UNION ALL ".join(
    f"SELECT '20240201_{h}0000' AS snapshot_ts, count(*) AS total_rows, count(*) FILTER (WHERE o_orderstatus = 'O') AS nulls, "
    f"{'TRUE' if h > 13 else 'FALSE'} AS kept FROM orders WHERE o_orderkey % 20 >= {h}" for h in SNAPSHOT_HOURS))
def snapshots_kept(spark, folder):
    """Summaries taken while writing, and which snapshots are still there: the newest five."""
    target = new_folder(spark, "kept")
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    orders = table(spark, folder, "orders").select("o_orderkey", status.alias("status"))
    written = None
    for hour in SNAPSHOT_HOURS:
        rows = orders.where(F.col("o_orderkey") % 20 >= hour)
        label, summary = bronze.database_snapshot(rows, target, NOON.replace(hour=hour))
        one = summary.select(
            F.lit(label).alias("snapshot_ts"), "total_rows", F.element_at("null_counts", "status").alias("nulls")
        )
        written = one if written is None else written.unionByName(one)
    there = writers.history(spark, target).groupBy("snapshot_ts").agg(F.lit(True).alias("there"))
    return written.join(there, "snapshot_ts", "left").select(
        "snapshot_ts", "total_rows", "nulls", F.coalesce("there", F.lit(False)).alias("kept")
    )


@query("range_of_ordered_files", "B1 D2 D4 F2 F6", RECONCILIATION_SQL + """
SELECT status, count(*) AS qtd, round(sum(amount), 2) AS total FROM conciliacoes
WHERE amount BETWEEN 100000 AND 200000 GROUP BY status""")
def range_of_ordered_files(spark, folder):
    """The range study over files that hold ranges of the amount."""
    path = new_folder(spark, "ordered")
    ordered = writers.overwrite_ordered(reconciliation(spark, folder), path, ["amount", "id"], equal=["supplier"])
    return rounded(RangeStudy(ordered, low=100000, high=200000).status(), "total")


def days_stored(spark, folder) -> daily.MergedDashboard:
    """Partial measures of seven ingestion days, one of them stored twice."""
    target, bronze_table = new_folder(spark, "days"), new_folder(spark, "ingested")
    ingested = F.date_add(F.lit(NOON.date()), (F.col("id") % 7).cast("int")).cast("string")
    writers.overwrite_ordered(
        reconciliation(spark, folder).withColumn("_ingestion_date", ingested), bronze_table, ["_ingestion_date"]
    )
    rows = readers.parquet_table(spark, bronze_table)
    for i in [*range(7), 3]:
        daily.store_day(rows, target, NOON.date() + timedelta(days=i))
    return daily.MergedDashboard(daily.stored_days(spark, target))


@query("merged_status_value", "F5 M12 M13 F15", RECONCILIATION_SQL + """
SELECT status, count(*) AS count, round(sum(amount), 2) AS total, round(avg(amount), 2) AS media,
       (SELECT round(count(*) FILTER (WHERE status = 'MATCHED') / count(*) * 100, 4) FROM conciliacoes) AS taxa_match
FROM conciliacoes GROUP BY status""")
def merged_status_value(spark, folder):
    merged = days_stored(spark, folder)
    values = merged.status_value().join(merged.status(), "status")
    whole = merged.summary().select("taxa_match")  # one row
    found = values.select("status", "count", "total", "media", whole.scalar().alias("taxa_match"))
    return rounded(rounded(found, "total", "media"), "taxa_match", digits=4)


@query("merged_daily", "F9 E6 M13", RECONCILIATION_SQL + """
SELECT CAST(created_at AS DATE) AS data, count(*) AS quantidade, round(sum(amount), 2) AS valor
FROM conciliacoes GROUP BY 1""")
def merged_daily(spark, folder):
    return rounded(days_stored(spark, folder).daily(), "valor")
