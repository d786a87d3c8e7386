"""Reports: filters, groups, rankings, profiles, listings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quaylake.functions import measures, text, time
from quaylake.operators import grouping, profiling, ranking
from quaylake.plans import gold
from quaylake.plans.reports import ConsoleReport, Dashboard, DumpReport, Profile, RangeStudy, SliceReport
from quaylake.registry.base import query, rounded, table
from quaylake.registry.inputs import LISTING_SQL, RECONCILIATION_SQL, listing_lines, reconciliation
from quaylake.sources.readers import inventory
from quaylake.sources.readers import query as sql_query

REC = RECONCILIATION_SQL
LOW, HIGH, LARGE = 100000, 200000, 400000
IN_RANGE = f"amount BETWEEN {LOW} AND {HIGH}"


# Console report


@query("console_total", "F1", REC + "SELECT count(*) AS total FROM conciliacoes")
def console_total(spark, folder):
    return ConsoleReport(reconciliation(spark, folder)).total()


@query("console_schema", "L2", """
SELECT column_name, CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS column_type
FROM (DESCRIBE lineitem)""")
def console_schema(spark, folder):
    return profiling.schema_listing(table(spark, folder, "lineitem"))


@query("console_status", "F3", REC + "SELECT status, count(*) AS count FROM conciliacoes GROUP BY status ORDER BY count DESC")
def console_status(spark, folder):
    return ConsoleReport(reconciliation(spark, folder)).status()


@query("console_status_value", "F5", REC + """
SELECT status, round(sum(amount), 2) AS total, round(avg(amount), 2) AS media
FROM conciliacoes GROUP BY status ORDER BY total DESC""")
def console_status_value(spark, folder):
    return rounded(ConsoleReport(reconciliation(spark, folder)).status_value(), "total", "media")


@query("console_top_suppliers", "G1 D5 M12", REC + """
SELECT supplier, count(*) AS count, round(sum(amount), 2) AS total FROM conciliacoes
WHERE supplier IS NOT NULL GROUP BY supplier ORDER BY count DESC, supplier LIMIT 10""")
def console_top_suppliers(spark, folder):
    return rounded(ConsoleReport(reconciliation(spark, folder)).top_suppliers(), "total")


# Dashboard


@query("dashboard_status_value", "F4", REC + """
SELECT status, round(sum(amount), 2) AS total FROM conciliacoes GROUP BY status ORDER BY total DESC""")
def dashboard_status_value(spark, folder):
    return rounded(Dashboard(reconciliation(spark, folder)).status_value(), "total")


@query("dashboard_top_suppliers", "G2", REC + """
SELECT supplier, count(*) AS count, round(sum(amount), 2) AS total FROM conciliacoes
WHERE supplier IS NOT NULL GROUP BY supplier ORDER BY sum(amount) DESC, supplier LIMIT 10""")
def dashboard_top_suppliers(spark, folder):
    return rounded(Dashboard(reconciliation(spark, folder)).top_suppliers(), "total")


@query("dashboard_daily", "F9 E6 G9 M13", REC + """
SELECT CAST(created_at AS DATE) AS data, count(*) AS quantidade, round(sum(amount), 2) AS valor
FROM conciliacoes GROUP BY 1 ORDER BY 1""")
def dashboard_daily(spark, folder):
    return rounded(Dashboard(reconciliation(spark, folder)).daily(), "valor")


@query("dashboard_summary", "F15 E12", REC + """
SELECT count(*) AS total_registros, round(sum(amount), 2) AS total_valor,
       count(*) FILTER (WHERE status = 'MATCHED') AS matched,
       round(count(*) FILTER (WHERE status = 'MATCHED') / count(*) * 100, 4) AS taxa_match
FROM conciliacoes""")
def dashboard_summary(spark, folder):
    summary = Dashboard(reconciliation(spark, folder)).summary()
    return rounded(rounded(summary, "total_valor"), "taxa_match", digits=4)


@query("daily_events", "F9", """
SELECT CAST(ts AS DATE) AS data, count(*) AS quantidade, round(sum(value), 2) AS valor
FROM events GROUP BY 1 ORDER BY 1""")
def daily_events(spark, folder):
    return rounded(grouping.daily_series(table(spark, folder, "events"), "ts", "value"), "valor")


@query("top_suppliers_by_sales", "G2", """
SELECT l_suppkey, count(*) AS count, round(sum(l_extendedprice), 2) AS total
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey ORDER BY sum(l_extendedprice) DESC, l_suppkey LIMIT 10""")
def top_suppliers_by_sales(spark, folder):
    wanted = {"count": "rows", "total": "sum"}
    lines = table(spark, folder, "lineitem")
    return rounded(ranking.top_groups(lines, "l_suppkey", "l_extendedprice", wanted, "total", 10), "total")


# Range study


def study(spark, folder):
    return RangeStudy(reconciliation(spark, folder), low=LOW, high=HIGH, threshold=LARGE)


@query("range_large", "D3 G5 C11", REC + f"""
SELECT id, status, amount, supplier FROM conciliacoes WHERE amount > {LARGE} ORDER BY amount DESC, id LIMIT 5""")
def range_large(spark, folder):
    return study(spark, folder).large()


@query("range_rows", "D4 G5", REC + f"""
SELECT id, status, source, amount, supplier, created_at FROM conciliacoes
WHERE {IN_RANGE} ORDER BY amount DESC, id LIMIT 20""")
def range_rows(spark, folder):
    return study(spark, folder).rows()


@query("range_totals", "F2 F1 D4", REC + f"""
SELECT count(*) AS quantidade, round(sum(amount), 2) AS total, round(avg(amount), 2) AS media
FROM conciliacoes WHERE {IN_RANGE}""")
def range_totals(spark, folder):
    return rounded(study(spark, folder).totals(), "total", "media")


@query("range_status", "F6", REC + f"""
SELECT status, count(*) AS qtd, round(sum(amount), 2) AS total FROM conciliacoes
WHERE {IN_RANGE} GROUP BY status ORDER BY qtd DESC""")
def range_status(spark, folder):
    return rounded(study(spark, folder).status(), "total")


@query("range_top_suppliers", "G3 D7", REC + f"""
SELECT supplier, count(*) AS qtd, round(sum(amount), 2) AS total FROM conciliacoes
WHERE {IN_RANGE} AND supplier IS NOT NULL GROUP BY supplier ORDER BY qtd DESC, supplier LIMIT 5""")
def range_top_suppliers(spark, folder):
    return rounded(study(spark, folder).top_suppliers(), "total")


@query("range_slice", "G8 C10 M14", REC + f"SELECT * FROM conciliacoes WHERE {IN_RANGE} ORDER BY amount DESC, id")
def range_slice(spark, folder):
    return study(spark, folder).slice()


DESCRIBED = """
  count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
  round(quantile_cont({c}, 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max
"""


def described(columns: list[str], source: str) -> str:
    parts = [f"SELECT '{c}' AS \"column\", {DESCRIBED.format(c=f'CAST({c} AS DOUBLE)')} FROM {source}" for c in columns]
    return " UNION ALL ".join(parts)


STATISTICS = ("mean", "std", "p25", "p50", "p75")


@query("range_statistics", "F11", REC + described(["amount", "match_score"], f"(SELECT * FROM conciliacoes WHERE {IN_RANGE})"))
def range_statistics(spark, folder):
    return rounded(study(spark, folder).statistics(), *STATISTICS, digits=4)


@query("describe_lineitem", "F11", described(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem"))
def describe_lineitem(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profiling.describe(table(spark, folder, "lineitem"), columns), *STATISTICS, digits=4)


@query("slice_by_status", "F8 F7", REC + """
SELECT status, count(amount) AS count, round(sum(amount), 2) AS sum, round(avg(amount), 2) AS mean
FROM conciliacoes WHERE status IS NOT NULL GROUP BY status""")
def slice_by_status(spark, folder):
    return rounded(SliceReport(reconciliation(spark, folder)).status(), "sum", "mean")


@query("slice_by_reason", "F8", REC + """
SELECT match_reason, count(match_score) AS count, CAST(sum(match_score) AS BIGINT) AS sum
FROM conciliacoes WHERE match_reason IS NOT NULL GROUP BY match_reason""")
def slice_by_reason(spark, folder):
    wanted = {"count": "count", "sum": "sum"}
    return grouping.measure_by(reconciliation(spark, folder), "match_reason", "match_score", wanted, null_keys=False)


@query("slice_largest", "G6", REC + """
SELECT status, amount, supplier, match_reason FROM conciliacoes ORDER BY amount DESC, id LIMIT 5""")
def slice_largest(spark, folder):
    return SliceReport(reconciliation(spark, folder)).largest()


@query("slice_unmatched", "F16 D2 D6", REC + """
SELECT count(*) FILTER (WHERE status = 'UNMATCHED') AS unmatched,
       round(coalesce(sum(amount) FILTER (WHERE status = 'UNMATCHED'), 0), 2) AS unmatched_valor,
       count(*) FILTER (WHERE status IN ('UNMATCHED', 'UNMATCHED_MOVEMENT')) AS sem_match
FROM conciliacoes""")
def slice_unmatched(spark, folder):
    return rounded(SliceReport(reconciliation(spark, folder)).unmatched(), "unmatched_valor")


# Filters


@query("filter_equal", "D2", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_equal(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("filter_any_of", "D6", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P')")
def filter_any_of(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_orderstatus").isin("O", "P")).select("o_orderkey")


@query("filter_text", "D8", """
SELECT p_partkey, p_name FROM part
WHERE contains(p_name, 'l') AND NOT contains(p_name, 'blue') AND (starts_with(p_name, 'red') OR suffix(p_name, 'ring'))""")
def filter_text(spark, folder):
    name = F.col("p_name")
    wanted = name.contains("l") & ~name.contains("blue") & (name.startswith("red") | name.endswith("ring"))
    return table(spark, folder, "part").filter(wanted).select("p_partkey", "p_name")


@query("filter_present_in_range", "D5 D7", REC + f"""
SELECT id, supplier, amount FROM conciliacoes WHERE {IN_RANGE} AND supplier IS NOT NULL""")
def filter_present_in_range(spark, folder):
    rows = grouping.within(reconciliation(spark, folder), "amount", LOW, HIGH)
    return rows.filter(F.col("supplier").isNotNull()).select("id", "supplier", "amount")


# Profile


@query("profile_summary", "F14", """
SELECT count(*) AS total_rows, 6 AS total_columns,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
       array_to_string([count(*) - count(o_orderkey), count(*) - count(o_custkey), count(*) - count(o_orderstatus),
         count(*) - count(o_totalprice), count(*) - count(o_orderdate), count(*) - count(o_orderpriority)], ',') AS nulls
FROM (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
             nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)""")
def profile_summary(spark, folder):
    orders = table(spark, folder, "orders").withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
    })
    summary = profiling.dataset_summary(orders)
    counts = F.transform("columns", lambda c: F.element_at("null_counts", c).cast("string"))
    return summary.select(
        "total_rows", "total_columns", F.array_join("columns", ",").alias("columns"), F.array_join(counts, ",").alias("nulls"),
    )


REC_COLUMNS = ("id", "run_id", "status", "source", "supplier", "amount", "created_at", "match_reason", "match_score")


@query("profile_nulls", "F12", REC + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM conciliacoes" for c in REC_COLUMNS))
def profile_nulls(spark, folder):
    return Profile(reconciliation(spark, folder)).nulls()


@query("profile_distinct", "F13", REC + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values,
    CASE WHEN count(DISTINCT {c}) <= 10 THEN string_agg(DISTINCT {c}, '|' ORDER BY {c}) END AS "values" FROM conciliacoes"""
    for c in ("run_id", "status", "source", "supplier", "match_reason")))
def profile_distinct(spark, folder):
    found = Profile(reconciliation(spark, folder)).distinct()
    return found.withColumn("values", F.array_join("values", "|"))


@query("profile_reasons", "F10", REC + """
SELECT match_reason, count(*) AS count FROM conciliacoes WHERE match_reason IS NOT NULL
GROUP BY match_reason ORDER BY count DESC, match_reason""")
def profile_reasons(spark, folder):
    return Profile(reconciliation(spark, folder)).counts("match_reason")


@query("profile_runs", "F10", REC + "SELECT run_id, count(*) AS count FROM conciliacoes GROUP BY run_id")
def profile_runs(spark, folder):
    return Profile(reconciliation(spark, folder)).counts("run_id")


@query("profile_top_suppliers", "G4", REC + """
SELECT supplier, count(*) AS count FROM conciliacoes WHERE supplier IS NOT NULL
GROUP BY supplier ORDER BY count DESC, supplier LIMIT 10""")
def profile_top_suppliers(spark, folder):
    return Profile(reconciliation(spark, folder)).top_suppliers()


@query("profile_by_status", "F7 M15", REC + """
SELECT status, count(amount) AS count, round(sum(amount), 2) AS sum, round(avg(amount), 2) AS mean,
       min(amount) AS min, max(amount) AS max
FROM conciliacoes WHERE status IS NOT NULL GROUP BY status""")
def profile_by_status(spark, folder):
    return rounded(Profile(reconciliation(spark, folder)).by_status(), "sum", "mean")


@query("profile_head", "G7", REC + "SELECT * FROM conciliacoes ORDER BY id LIMIT 5")
def profile_head(spark, folder):
    return Profile(reconciliation(spark, folder)).head()


# Distinct, sorts, ad hoc SQL


@query("distinct_rows", "F18", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem")
def distinct_rows(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity").distinct()


@query("distinct_suppliers", "F19", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_suppliers(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey").distinct()


@query("sorted_names", "G9", "SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def sorted_names(spark, folder):
    return ranking.sorted_ascending(table(spark, folder, "part").select("p_name", "p_partkey"), "p_name", "p_partkey")


@query("sorted_amounts", "G8", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sorted_amounts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ranking.sorted_by_amount(orders, "o_totalprice", ["o_orderkey"])


@query("adhoc_sql", "L1 C13", REC + """, late AS (SELECT * FROM conciliacoes WHERE status = 'UNMATCHED' AND amount > 250000)
SELECT source, run_id, count(*) AS n, max(amount) AS largest FROM late GROUP BY source, run_id""")
def adhoc_sql(spark, folder):
    statement = """
    WITH late AS (SELECT * FROM conciliacoes WHERE status = :status AND amount > :least)
    SELECT source, run_id, count(*) AS n, max(amount) AS largest FROM late GROUP BY source, run_id
    """
    tables = {"conciliacoes": reconciliation(spark, folder)}
    return sql_query(spark, statement, tables, {"status": "UNMATCHED", "least": 250000})


@query("sales_summary", "F17 E5 M11", """
SELECT DATE '2024-02-01' AS data_referencia, count(*) AS qtd_linhas_pcnfsaid FROM lineitem""")
def sales_summary(spark, folder):
    return gold.sales_summary(table(spark, folder, "lineitem"), date(2024, 2, 1))


# Formats and scalar functions


@query("formatted_amounts", "E11", r"""
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS money, format('{:,.0f}', o_totalprice) AS whole,
       format('{:20s}', o_orderpriority) AS padded, format('{:>8s}', CAST(o_custkey AS VARCHAR)) AS aligned,
       left(o_orderpriority, 5) AS short
FROM orders""")
def formatted_amounts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.grouped_digits(F.col("o_totalprice")).alias("money"),
        text.grouped_digits(F.col("o_totalprice"), 0).alias("whole"),
        text.left_aligned(F.col("o_orderpriority"), 20).alias("padded"),
        text.right_aligned(F.col("o_custkey"), 8).alias("aligned"),
        text.shortened(F.col("o_orderpriority"), 5).alias("short"),
    )


@query("rates_by_priority", "E12", """
SELECT o_orderpriority, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) * 100, 4) AS rate,
       CAST(NULL AS DOUBLE) AS none
FROM orders GROUP BY o_orderpriority""")
def rates_by_priority(spark, folder):
    done = F.count_if(F.col("o_orderstatus") == "F")
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.round(measures.percentage(done, F.count(F.lit(1))), 4).alias("rate"),
        measures.percentage(done, F.count_if(F.lit(False))).alias("none"),
    )


@query("file_kinds", "A11 E13 E15", """
SELECT CASE lang WHEN 'en' THEN 'CSV Original' WHEN 'fr' THEN 'DataFrame Exportado' ELSE 'Outro' END AS kind,
       CASE lang WHEN 'en' THEN 'data-' WHEN 'fr' THEN 'df_' ELSE lang || '-' END || doc_id || '.csv' AS file,
       round(octet_length(encode(text)) / 1024, 1) AS size_kb
FROM documents ORDER BY file""")
def file_kinds(spark, folder):
    lang = F.col("lang")
    prefix = F.when(lang == "en", "data-").when(lang == "fr", "df_").otherwise(F.concat(lang, F.lit("-")))
    files = table(spark, folder, "documents").select(
        F.concat(prefix, "doc_id", F.lit(".csv")).alias("file"),
        F.octet_length("text").alias("length"),
    )
    return inventory(files)


@query("document_sizes", "E15", "SELECT doc_id, round(n_chars / 1024, 4) AS kb, round(n_chars / 1048576, 6) AS mb FROM documents")
def document_sizes(spark, folder):
    n = F.col("n_chars")
    return table(spark, folder, "documents").select(
        "doc_id", F.round(measures.kilobytes(n), 4).alias("kb"), F.round(measures.megabytes(n), 6).alias("mb")
    )


@query("snapshot_labels", "E16 E6", """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS label, CAST(ts AS DATE) AS day FROM events""")
def snapshot_labels(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", time.snapshot_label(F.col("ts")).alias("label"), time.day_of(F.col("ts")).alias("day")
    )


@query("name_tokens", "E14", LISTING_SQL + """
SELECT n, string_split(value, ' ')[-2] AS name, CASE WHEN len(string_split(value, ' ')) >= 8 THEN string_split(value, ' ')[-8] END AS eighth
FROM lines""")
def name_tokens(spark, folder):
    return listing_lines(spark, folder).select(
        "n",
        text.token_from_end(F.col("value"), 2, 4).alias("name"),
        text.token_from_end(F.col("value"), 8, 8).alias("eighth"),
    )


# Dump listing


@query("listing_objects", "F20 D8", LISTING_SQL + """
SELECT count(*) FILTER (WHERE contains(value, 'TABLE') AND contains(value, 'public') AND NOT contains(value, 'TABLE DATA')) AS tables,
       count(*) FILTER (WHERE contains(value, 'INDEX')) AS indexes,
       count(*) FILTER (WHERE contains(value, 'CONSTRAINT')) AS constraints,
       count(*) FILTER (WHERE contains(value, 'FK CONSTRAINT')) AS foreign_keys
FROM lines""")
def listing_objects(spark, folder):
    return DumpReport(listing_lines(spark, folder)).objects()


@query("listing_tables", "F19 E14 G9", LISTING_SQL + "SELECT name FROM names ORDER BY name")
def listing_tables(spark, folder):
    return DumpReport(listing_lines(spark, folder)).tables()


@query("listing_mentions", "H1 M16", LISTING_SQL + """
SELECT name,
       count(*) FILTER (WHERE contains(value, name || '_') AND contains(value, 'INDEX')) AS indexes,
       count(*) FILTER (WHERE contains(value, name) AND contains(value, 'FK CONSTRAINT')) AS foreign_keys
FROM names CROSS JOIN lines GROUP BY name ORDER BY name""")
def listing_mentions(spark, folder):
    return DumpReport(listing_lines(spark, folder)).mentions()


@query("listing_header", "M16", LISTING_SQL + """
SELECT n, ';' || value AS value FROM lines WHERE n % 3 = 0 ORDER BY n""")
def listing_header(spark, folder):
    """Every third line is a comment."""
    comment = F.when(F.col("n") % 3 == 0, F.concat(F.lit(";"), "value")).otherwise(F.col("value"))
    return DumpReport(listing_lines(spark, folder).withColumn("value", comment)).header()
