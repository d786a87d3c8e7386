"""Casts, text cleaning and the silver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.functions import casting, text, time
from quaylake.operators import filters
from quaylake.plans import silver
from quaylake.registry.base import decimals_as_text, query, table, without_zone


@query("strict_casts", "E1", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 4)) AS VARCHAR) AS price4,
       CAST(CAST(o_totalprice AS DECIMAL(18, 6)) AS VARCHAR) AS price6, CAST(CAST(o_custkey AS DECIMAL(38, 0)) AS VARCHAR) AS customer, CAST(o_custkey AS INTEGER) AS small, o_totalprice AS price,
       o_orderdate AS moment, CAST(o_orderdate AS DATE) AS day, CAST(o_custkey AS VARCHAR) AS label
FROM orders""")
def strict_casts(spark, folder):
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    customer, moment = F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    texts = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string"), price.alias("price4"), price.alias("price6"),
        customer.alias("customer"), customer.alias("small"), price.alias("price"),
        moment.alias("moment"), F.substring(moment, 1, 10).alias("day"), F.col("o_custkey").alias("label"),
    )
    types = {
        "o_orderkey": "bigint", "price4": "decimal(18,4)", "price6": "decimal(18,6)", "customer": "decimal(38,0)",
        "small": "int", "price": "double", "moment": "timestamp", "day": "date", "label": "string",
    }
    return without_zone(decimals_as_text(texts.select(*casting.strict_casts(types))), "moment")


@query("whole_numbers", "E1", """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS cut, CAST(round(o_totalprice) AS BIGINT) AS rounded FROM orders""")
def whole_numbers(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        casting.whole_number(price, "bigint").alias("cut"),
        casting.whole_number(price, "bigint", rounded=True).alias("rounded"),
    )


@query("clean_names", "E2", """
SELECT c_custkey, CASE WHEN c_nationkey <> 0 THEN c_name END AS name, CASE WHEN c_nationkey <> 1 THEN c_mktsegment END AS segment
FROM customer""")
def clean_names(spark, folder):
    blank = F.when(F.col("c_nationkey") == 0, "   ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    padded = F.when(F.col("c_nationkey") != 1, F.rpad("c_mktsegment", 14, " "))
    return table(spark, folder, "customer").select(
        "c_custkey", text.clean_text(blank).alias("name"), text.clean_text(padded).alias("segment")
    )


@query("iso_timestamps", "E3", "SELECT event_id, date_trunc('second', ts) AS moment FROM events")
def iso_timestamps(spark, folder):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    moment = time.iso_to_timestamp(F.concat(iso, F.lit("+00:00"))).alias("moment")
    return without_zone(table(spark, folder, "events").select("event_id", moment), "moment")


@query("tolerant_times", "E7 E8", """
SELECT event_id, CASE event_type WHEN 'click' THEN ts WHEN 'view' THEN date_trunc('day', ts) WHEN 'signup' THEN date_trunc('day', ts) END AS moment,
       CASE WHEN event_type IN ('click', 'view', 'signup') THEN CAST(ts AS DATE) END AS day
FROM events""")
def tolerant_times(spark, folder):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "signup", F.date_format("ts", "dd/MM/yyyy"))
        .when(kind == "error", F.lit("2024-13-45"))
        .otherwise(F.lit("sem data"))
    )
    formats = ["dd/MM/yyyy"]
    return without_zone(
        table(spark, folder, "events").select(
            "event_id",
            casting.to_timestamp_or_null(raw, formats).alias("moment"),
            casting.to_date_or_null(raw, formats).alias("day"),
        ),
        "moment",
    )


@query("tolerant_numbers", "E9 E10", """
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL ELSE value END AS value,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(user_id AS VARCHAR) AS user_text
FROM events""")
def tolerant_numbers(spark, folder):
    kind, value = F.col("event_type"), F.col("value").cast("string")
    raw = (
        F.when(kind == "error", F.concat(value, F.lit(" km")))
        .when(kind == "signup", F.concat(value, F.lit("d")))
        .when(kind == "view", F.concat(F.lit(" "), value, F.lit(" ")))
        .otherwise(value)
    )
    return table(spark, folder, "events").select(
        "event_id",
        casting.to_number(raw).alias("value"),
        casting.to_number(F.get_json_object("props", "$.k")).alias("k"),
        casting.to_text(F.col("user_id")).alias("user_text"),
    )


@query("keys_present", "D1", """
SELECT id, supplier, match_reason FROM (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS supplier,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS match_reason FROM orders)
WHERE id IS NOT NULL AND supplier IS NOT NULL AND match_reason IS NOT NULL""")
def all_keys_present(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("supplier"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("match_reason"),
    )
    return filters.keys_present(rows, ["id", "supplier", "match_reason"])


# Silver


def bronze_supervisors(spark, folder) -> DataFrame:
    """Customers as supervisor texts, every row twice."""
    texts = table(spark, folder, "customer").select(
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd 08:30:00").alias("dtadmissao"),
        F.when(F.col("c_nationkey") > 12, "2023-05-06 00:00:00").alias("dtdemissao"),
        F.col("c_acctbal").cast("string").alias("percomissao"),
        F.col("c_acctbal").cast("string").alias("vlcorrente"),
        F.col("c_custkey").cast("string").alias("cod_cadrca"),
        F.col("c_nationkey").cast("string").alias("percpartvendaprev"),
        F.col("c_nationkey").cast("string").alias("percmargemprev"),
        F.col("c_custkey").cast("string").alias("codcoordenador"),
        F.col("c_custkey").cast("string").alias("vllimcred"),
        F.lit(None).cast("string").alias("dt_vmais"),
        F.lit("2024-01-02T03:04:05.678+00:00").alias("_ingestion_ts_utc"),
        F.lit("2024-01-02").alias("_ingestion_date"),
        F.col("c_name").alias("not_taken"),
    )
    return texts.unionAll(texts)


@query("silver_supervisors", "M9 E1 F18", """
SELECT DISTINCT CAST(DATE '2020-01-01' + c_nationkey AS TIMESTAMP) + INTERVAL '8 hours 30 minutes' AS dtadmissao,
       CASE WHEN c_nationkey > 12 THEN TIMESTAMP '2023-05-06 00:00:00' END AS dtdemissao,
       c_acctbal AS percomissao, c_acctbal AS vlcorrente, CAST(c_custkey AS DOUBLE) AS cod_cadrca,
       c_nationkey AS percpartvendaprev, c_nationkey AS percmargemprev, CAST(c_custkey AS INTEGER) AS codcoordenador,
       c_custkey AS vllimcred, CAST(NULL AS BIGINT) AS dt_vmais,
       '2024-01-02T03:04:05.678+00:00' AS _ingestion_ts_utc, DATE '2024-01-02' AS _ingestion_date
FROM customer""")
def silver_supervisors(spark, folder):
    return without_zone(silver.supervisors(bronze_supervisors(spark, folder)), "dtadmissao", "dtdemissao")


# Source of each invoice column: an orders column for keys, dimensions and measures in turn.
WHOLE_SOURCES = ("o_custkey", "o_orderkey")
TEXT_SOURCES = ("o_orderpriority", "o_orderstatus")
PLAIN_KEYS = {"codfilial": "o_custkey", "numnota": "o_orderkey", "codigo": "o_orderkey", "codcli": "o_custkey"}


def invoice_source(number: int, kind: str) -> str:
    return WHOLE_SOURCES[number % 2] if kind != "text" else TEXT_SOURCES[number % 2]


def bronze_invoices(spark, folder) -> DataFrame:
    """Orders as invoice texts: padded, some blank, some without a key, every row twice with
    different padding."""
    orders = table(spark, folder, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    keys = {name: F.col(source).cast("string") for name, source in PLAIN_KEYS.items()}
    keys["codcli"] = F.when(F.col("o_orderpriority") != "5-LOW", keys["codcli"])
    keys["codfilial"] = F.when(F.col("o_orderstatus") != "P", keys["codfilial"])
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    columns = [keys[k].alias(k) if k in keys else moment.alias(k) for k in silver.INVOICE_KEYS]
    others = [k for k in silver.INVOICE_TYPES if k not in silver.INVOICE_KEYS]
    columns += [F.col(invoice_source(i, "whole")).cast("string").alias(k) for i, k in enumerate(others)]
    columns += [F.col("price").cast("string").alias(k) for k in silver.INVOICE_MEASURES]
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")

    def padded(pad: str) -> DataFrame:
        texts = [
            F.when(F.col("o_orderstatus") == "F", F.lit(pad)).otherwise(F.concat(F.lit(pad), invoice_source(i, "text"))).alias(k)
            for i, k in enumerate(silver.INVOICE_TEXTS)
        ]
        return orders.select(
            *columns, *texts, F.concat(iso, F.lit("+00:00")).alias("_ingestion_ts_utc"),
            F.substring(moment, 1, 10).alias("_ingestion_date"), F.lit("x").alias("not_taken"),
        )

    return padded(" ").unionAll(padded("   "))


def invoices_sql() -> str:
    def typed(expression: str, kind: str) -> str:
        cast = f"CAST({expression} AS {kind})"
        return f"CAST({cast} AS VARCHAR)" if kind.startswith("decimal") else cast

    columns = []
    for name, kind in silver.INVOICE_KEYS.items():
        columns.append(f"{typed(PLAIN_KEYS.get(name, 'o_orderdate'), kind)} AS {name}")
    others = [(k, t) for k, t in silver.INVOICE_TYPES.items() if k not in silver.INVOICE_KEYS]
    columns += [f"{typed(invoice_source(i, 'whole'), t)} AS {k}" for i, (k, t) in enumerate(others)]
    columns += [f"{typed('o_totalprice', silver.INVOICE_MEASURE_TYPE)} AS {k}" for k in silver.INVOICE_MEASURES]
    columns += [
        f"CASE WHEN o_orderstatus <> 'F' THEN {invoice_source(i, 'text')} END AS {k}"
        for i, k in enumerate(silver.INVOICE_TEXTS)
    ]
    columns += [
        "date_trunc('second', o_orderdate) AS _ingestion_ts_utc", "CAST(o_orderdate AS DATE) AS _ingestion_date",
        "TIMESTAMP '2024-02-01 03:04:05' AS _silver_ts_utc",
    ]
    return (
        f"SELECT DISTINCT {', '.join(columns)} FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"
    )


@query("silver_invoices", "M10 D1 E1 E2 E3 E4 F18", invoices_sql())
def silver_invoices(spark, folder):
    clean = silver.invoices(bronze_invoices(spark, folder), datetime(2024, 2, 1, 3, 4, 5))
    return without_zone(decimals_as_text(clean), "data_faturamento", "_ingestion_ts_utc", "_silver_ts_utc")
