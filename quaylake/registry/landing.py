"""Landed pages, records, reshaping and the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.operators import records, reshape
from quaylake.plans import bronze
from quaylake.plans.endpoints import ENDPOINTS, MAINTENANCE_REMINDERS
from quaylake.registry.base import plain_name, plain_names, query, table, without_zone
from quaylake.registry.inputs import ORDER_RUNS_SQL, landed, order_runs, wrapped

# Pages


def order_record():
    return F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("code"), F.col("o_totalprice").alias("amount"))


ORDER_FIELDS = {"id": "bigint", "code": "string", "amount": "double"}


def order_pages(spark, folder) -> DataFrame:
    return landed(table(spark, folder, "orders"), "o_orderkey", wrapped("o_orderkey", order_record()))


@query("page_envelopes", "A1 C11", """
SELECT CAST(o_orderkey // 500 + 1 AS INTEGER) AS page, o_orderkey AS id, o_orderpriority AS code FROM orders""")
def page_envelopes(spark, folder):
    """The records stand under another member from page to page, among others that are not records."""
    pages = landed(table(spark, folder, "orders"), "o_orderkey", F.to_json(order_record()))
    inner = F.substring(F.col("payload"), 12, F.length("payload") - 12)
    shapes = [
        F.concat(F.lit('{"total":1,"content":'), inner, F.lit(',"data":[{"id":-1}]}')),
        F.concat(F.lit('{"content":null,"data":'), inner, F.lit("}")),
        F.concat(F.lit('{"data":{"id":-1},"results":'), inner, F.lit("}")),
        F.concat(F.lit('{"rows":'), inner, F.lit(',"aaa":[{"id":-1}]}')),
        F.concat(F.lit('{"items":'), F.substring(inner, 1, F.length(inner) - 1), F.lit(',7,"x",null,[]]'), F.lit("}")),
        inner,
        F.concat(F.lit('{"z":3,"mixed":[{"id":-1},1],"with space":'), inner, F.lit(',"aaa":[{"id":-1}]}')),
    ]
    payload = shapes[0]
    for i, shape in enumerate(shapes[1:], start=1):
        payload = F.when(F.col("page") % len(shapes) == i, shape).otherwise(payload)
    found = records.page_records(pages.withColumn("payload", payload))
    return records.select_fields(found, {"id": "bigint", "code": "string"}, keep=["page"])


SEQUENCE_SIZE = 380
MANY_URGENT = 108


@query("page_sequence", "A2", ORDER_RUNS_SQL + f"""
, sizes AS (SELECT run, page, count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS n FROM placed GROUP BY run, page),
stops AS (SELECT run, min(page) AS stop FROM sizes WHERE n < {SEQUENCE_SIZE} GROUP BY run)
SELECT run, page, o_orderkey AS id FROM placed LEFT JOIN stops USING (run)
WHERE o_orderpriority <> '5-LOW' AND (stop IS NULL OR page <= stop)""")
def page_sequence(spark, folder):
    """Low orders stand as bare numbers, which are no records, so some pages are short."""
    orders, runs, page = order_runs(spark, folder)
    record = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderkey").cast("string")).otherwise(F.to_json(order_record()))
    pages = landed(orders, "o_orderkey", record, page, runs)
    kept = records.page_sequence(pages, SEQUENCE_SIZE, None, runs=["run"])
    return records.select_fields(kept, {"id": "bigint"}, keep=["run", "page"])


LENIENT_SQL = ORDER_RUNS_SQL + f"""
, sizes AS (SELECT run, page, count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS n,
                   count(*) FILTER (WHERE o_orderpriority = '1-URGENT') > {MANY_URGENT} AS refused
            FROM placed GROUP BY run, page),
stops AS (SELECT run, least(min(page) FILTER (WHERE NOT refused AND n < {SEQUENCE_SIZE}), min(page) FILTER (WHERE refused) - 1) AS stop
          FROM sizes GROUP BY run)
"""


def refused_pages(spark, folder, record) -> DataFrame:
    """Runs of order pages; those with many urgent orders were answered with an error."""
    orders, runs, page = order_runs(spark, folder)
    many = F.count_if(F.col("o_orderpriority") == "1-URGENT") > MANY_URGENT
    return landed(orders, "o_orderkey", record, page, runs, F.when(many, 500).otherwise(200))


@query("page_sequence_lenient", "A3", LENIENT_SQL + """
SELECT run, page, o_orderkey AS id FROM placed LEFT JOIN stops USING (run)
WHERE o_orderpriority <> '5-LOW' AND (stop IS NULL OR page <= stop)""")
def page_sequence_lenient(spark, folder):
    low = F.col("o_orderpriority") == "5-LOW"
    pages = refused_pages(spark, folder, F.when(~low, F.to_json(order_record())))
    kept = records.page_sequence(pages, SEQUENCE_SIZE, None, ["run"], records.LENIENT)
    return records.select_fields(kept, {"id": "bigint"}, keep=["run", "page"])


@query("union_by_name", "A4", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier""")
def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").selectExpr("c_name name", "c_acctbal balance", "c_mktsegment segment")
    suppliers = table(spark, folder, "supplier").selectExpr("s_nationkey nation", "s_acctbal balance", "s_name name")
    return records.union_by_name([customers, suppliers])


@query("unwrapped_records", "C1 C3", "SELECT o_orderkey AS id, o_orderpriority AS code, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS absent FROM orders")
def unwrapped_records(spark, folder):
    found = records.unwrap_row(records.page_records(order_pages(spark, folder)))
    return records.select_fields(found, {**ORDER_FIELDS, "absent": "string"})


@query("unwrapped_strictly", "C2", """
SELECT page, id, count(*) AS n FROM (
  SELECT CAST(o_orderkey // 500 + 1 AS INTEGER) AS page, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey END AS id FROM orders)
GROUP BY page, id""")
def unwrapped_strictly(spark, folder):
    found = records.unwrap_row(records.page_records(order_pages(spark, folder)), strict=True)
    return records.select_fields(found, {"id": "bigint"}, keep=["page"]).groupBy("page", "id").agg(F.count(F.lit(1)).alias("n"))


# Reshaping


def nested_customers(spark, folder) -> DataFrame:
    """Customers with a record and two lists whose lengths, 0 to 3 and 0 to 2, come from the row."""
    first, second = F.col("c_nationkey") % 4, (F.col("c_nationkey") + 1) % 3
    elements = lambda n: F.slice(F.array(*[F.struct(F.lit(i).alias("number"), F.col("c_name").alias("of")) for i in (1, 2, 3)]), 1, n)
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_nationkey") != 3, F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))).alias("details"),
        F.when(F.col("c_nationkey") != 24, elements(first)).alias("a/list"),
        elements(second).alias("b.list"),
    )


@query("expanded_record", "C4", """
SELECT c_custkey AS id, CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS segment,
       CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS balance_1 FROM customer""")
def expanded_record(spark, folder):
    nested = nested_customers(spark, folder).select("id", "details")
    return plain_names(reshape.expand_record(nested, "details", {"segment": "segment", "balance": "balance.1"}))


@query("exploded_list", "C5", """
SELECT c_custkey AS id, i AS number FROM customer
LEFT JOIN (VALUES (1), (2), (3)) v(i) ON i <= c_nationkey % 4 AND c_nationkey <> 24""")
def exploded_list(spark, folder):
    exploded = reshape.explode_list(nested_customers(spark, folder).select("id", "a/list"), "a/list")
    return reshape.expand_record(exploded, "a/list", {"number": "number"})


@query("exploded_twice", "C6", """
SELECT c_custkey AS id, i AS first, j AS second FROM customer
LEFT JOIN (VALUES (1), (2), (3)) v(i) ON i <= c_nationkey % 4 AND c_nationkey <> 24
LEFT JOIN (VALUES (1), (2)) w(j) ON j <= (c_nationkey + 1) % 3""")
def exploded_twice(spark, folder):
    nested = nested_customers(spark, folder).drop("details")
    exploded = reshape.explode_list(reshape.explode_list(nested, "a/list"), "b.list")
    first = reshape.expand_record(exploded, "a/list", {"number": "first"})
    return reshape.expand_record(first, "b.list", {"number": "second"})


@query("renamed_ordered_prefixed", "C7 C8 C9", """
SELECT o_totalprice AS "row_VALOR_TOTAL", o_orderkey AS row_id_1, o_orderstatus AS row_o_orderstatus FROM orders""")
def renamed_ordered_prefixed(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    renamed = reshape.rename_columns(orders, {"o_orderkey": "id.1", "o_totalprice": "VALOR/TOTAL", "absent": "x"})
    return plain_names(reshape.prefix_columns(reshape.reorder_columns(renamed, ["VALOR/TOTAL", "absent", "id.1"]), "row."))


@query("journey_measures", "C12 E7", """
SELECT o_orderkey, o_orderdate AS entrada, CAST(NULL AS TIMESTAMP) AS saida, o_custkey / 60 AS duracao_minutos, o_totalprice / 1000 AS distancia_km
FROM orders""")
def journey_measures(spark, folder):
    journeys = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("enterTime"),
        F.col("o_custkey").alias("duration"), F.col("o_totalprice").alias("distance"),
    )
    return without_zone(reshape.journey_measures(journeys).drop("enterTime", "duration", "distance"), "entrada", "saida")


# Bronze tables


@query("bronze_vehicles", "M1 A2 C1 C3 C7", """
SELECT CASE WHEN p_partkey % 5 = 0 THEN 'V-' || p_partkey WHEN p_partkey % 5 = 1 THEN p_partkey || '.5' ELSE CAST(p_partkey AS VARCHAR) END AS "ID_VEICULO", p_name AS "VEICULO", p_brand AS "PLACA", p_type AS "STATUS_VEICULO",
       CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS "deviceCode" FROM part""")
def bronze_vehicles(spark, folder):
    """Ids that are no whole numbers are kept as they are."""
    key = F.col("p_partkey")
    odd = F.when(key % 5 == 0, F.concat(F.lit("V-"), key).cast("variant")).when(
        key % 5 == 1, F.concat(key, F.lit(".5")).cast("decimal(20,1)").cast("variant")
    ).otherwise(key.cast("variant"))
    record = F.struct(
        odd.alias("id"), F.col("p_name").alias("code"), F.col("p_brand").alias("licensePlate"),
        F.col("p_type").alias("vehicleStatus"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("deviceCode"),
    )
    pages = landed(table(spark, folder, "part"), "p_partkey", wrapped("p_partkey", record))
    return bronze.bronze_table(pages, "vehicles", max_pages=None)


@query("bronze_contact_drivers", "M2 C4 E8", """
SELECT c_name AS name, CAST(NULL AS VARCHAR) AS email, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cpf,
       CAST(c_custkey AS VARCHAR) AS rg, CAST(NULL AS VARCHAR) AS "phoneNumber", '01/02/1990' AS birthday,
       CAST(NULL AS VARCHAR) AS address, c_mktsegment AS type, CAST(NULL AS VARCHAR) AS registration,
       CAST(NULL AS VARCHAR) AS "cardId", CAST(NULL AS VARCHAR) AS "bloodType", CAST(NULL AS VARCHAR) AS pis,
       CAST(NULL AS VARCHAR) AS ctps, DATE '2021-03-04' AS "emissionDate", CAST(NULL AS VARCHAR) AS mop,
       CAST(NULL AS VARCHAR) AS username, CAST(NULL AS VARCHAR) AS "yellowLine",
       CASE WHEN c_nationkey <> 1 THEN 'B' END AS tipo, CASE WHEN c_nationkey <> 1 THEN CAST(c_custkey AS VARCHAR) END AS numero,
       CASE WHEN c_nationkey > 1 THEN DATE '2024-01-01' + c_nationkey END AS "expirationDate"
FROM customer""")
def bronze_contact_drivers(spark, folder):
    nation = F.col("c_nationkey")
    expiry = F.date_add(F.lit("2024-01-01").cast("date"), nation).cast("string")
    # An evening of that day west of Greenwich.
    expiry = F.when(nation % 3 == 2, F.concat(expiry, F.lit("T22:00:00-03:00"))).otherwise(expiry)
    expiry = F.when(nation == 0, "sem data").otherwise(expiry)
    plain = [
        F.col("c_name").alias("name"), F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("cpf"),
        F.col("c_custkey").alias("rg"), F.lit("01/02/1990").alias("birthday"), F.col("c_mktsegment").alias("type"),
        F.lit("2021-03-04T10:20:30Z").alias("emissionDate"),
    ]
    licence = F.struct(F.lit("B").alias("tipo"), F.col("c_custkey").alias("numero"), expiry.alias("expirationDate"))
    text = F.when(nation == 1, wrapped("c_custkey", F.struct(*plain, F.lit("none").alias("cnh")))).otherwise(
        wrapped("c_custkey", F.struct(*plain, licence.alias("cnh")))
    )
    pages = landed(table(spark, folder, "customer"), "c_custkey", text)
    return bronze.bronze_table(pages, "contact_drivers", max_pages=None)


DAILY_GIVEN = ("headDuration", "pointCount", "powerFailCount", "ignitionOn", "input1")


def daily_sql() -> str:
    given = {
        "headDuration": "o_totalprice", "pointCount": "CAST(o_custkey AS DOUBLE)", "powerFailCount": "CAST(NULL AS DOUBLE)",
        "ignitionOn": "CAST(o_orderkey AS DOUBLE)", "ignitionOff": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END", "input1": "CASE WHEN o_orderstatus = 'F' THEN 12.5 END",
    }
    numbers = [f'CAST({given.get(n, "NULL")} AS DOUBLE) AS "{n}"' for n in ENDPOINTS["vehicle_daily"].numbers]
    return f"""SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS date, {', '.join(numbers)},
    CAST(o_custkey AS VARCHAR) AS "ID_VEICULO", o_orderpriority AS "VEICULO", CAST(NULL AS VARCHAR) AS "PLACA" FROM orders"""


@query("bronze_vehicle_daily", "M3 E8 E9 E10", daily_sql())
def bronze_vehicle_daily(spark, folder):
    """Flags count as numbers, their text does not; an evening with an offset keeps its day."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    day = F.when(F.col("o_orderstatus") == "O", F.concat(day, F.lit("T22:30:00-03:00"))).otherwise(day)
    day = F.when(F.col("o_orderpriority") == "5-LOW", "amanhã").otherwise(day)
    record = F.struct(
        day.alias("date"), F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("code")).alias("vehicle"),
        F.col("o_totalprice").alias("headDuration"), F.col("o_custkey").cast("string").alias("pointCount"),
        F.lit("n/a").alias("powerFailCount"), F.col("o_orderkey").alias("ignitionOn"),
        (F.col("o_orderstatus") == "F").alias("ignitionOff"), F.lit("true").alias("input2"),
        F.when(F.col("o_orderstatus") == "F", F.lit(12.5)).alias("input1"),
    )
    pages = landed(table(spark, folder, "orders"), "o_orderkey", wrapped("o_orderkey", record))
    return bronze.bronze_table(pages, "vehicle_daily", max_pages=None)


@query("bronze_driver_journeys", "M4 A3 A4 C4 C12 E7", LENIENT_SQL.replace("AS n,", "AS unused, count(*) AS n,").replace(f"n < {SEQUENCE_SIZE}", "n < 500") + """
SELECT o_orderkey AS journey, o_custkey AS motorista_id, o_orderpriority AS motorista_nome,
       CAST(NULL AS VARCHAR) AS veiculo_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS veiculo_codigo,
       o_orderdate AS entrada, CAST(NULL AS TIMESTAMP) AS saida, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "enterTime",
       o_custkey AS duration, o_totalprice AS distance, o_orderstatus AS "odd_start address", o_custkey AS "odd_a-b", o_orderkey AS odd_double,
       o_custkey / 60 AS duracao_minutos, o_totalprice / 1000 AS distancia_km
FROM placed LEFT JOIN stops USING (run) WHERE stop IS NULL OR page <= stop""")
def bronze_driver_journeys(spark, folder):
    plain = [
        F.col("o_orderkey").alias("journey"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name")).alias("driver"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("enterTime"),
        F.col("o_custkey").alias("duration"), F.col("o_totalprice").alias("distance"),
        F.struct(
            F.col("o_orderstatus").alias("start address"), F.col("o_custkey").alias("a-b"),
            F.struct(F.col("o_orderkey").alias("DECIMAL(3, 1)`x")).alias("OBJECT<d.e>"),
        ).alias("odd keys"),
    ]
    text = F.when(F.col("o_orderstatus") == "P", F.to_json(F.struct(*plain, F.lit(0).alias("vehicle")))).otherwise(
        F.to_json(F.struct(*plain, F.struct(F.col("o_orderstatus").alias("code")).alias("vehicle")))
    )
    table_ = bronze.driver_journeys(refused_pages(spark, folder, text), max_pages=None, runs=("run",))
    odd = F.col("odd keys")
    table_ = table_.withColumns({
        "odd_start address": odd["start address"], "odd_a-b": odd["a-b"], "odd_double": odd["OBJECT<d.e>"]["DECIMAL(3, 1)`x"],
    }).drop("odd keys")
    return without_zone(table_, "entrada", "saida")


@query("bronze_notifications", "M5 C4 E7 E9", """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS "eventDate", CAST(NULL AS VARCHAR) AS address, props AS description,
       CASE WHEN event_type <> 'error' THEN value END AS "newValue", CAST(NULL AS VARCHAR) AS "newState",
       CAST(NULL AS VARCHAR) AS "fenceId", '["' || event_type || '",1]' AS "rulesList", CAST(NULL AS VARCHAR) AS "driverKeyId",
       CAST(NULL AS DOUBLE) AS seconds, CAST(user_id AS VARCHAR) AS id_1, event_type AS code, CAST(NULL AS VARCHAR) AS "licensePlate",
       'D-' || event_id AS id_2, 'name ' || user_id AS name, CAST(NULL AS VARCHAR) AS "taxpayerId", CAST(user_id AS VARCHAR) AS "cardId",
       CAST(NULL AS VARCHAR) AS id_3, event_type AS name_1, CAST(NULL AS VARCHAR) AS property
FROM events""")
def bronze_notifications(spark, folder):
    kind = F.col("event_type")
    value = F.when(kind == "error", "-").otherwise(F.col("value").cast("string"))
    record = F.struct(
        F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("eventDate"),
        F.struct(F.col("user_id").alias("id"), kind.alias("code")).alias("vehicle"),
        F.struct(F.concat(F.lit("D-"), "event_id").alias("id"), F.concat(F.lit("name "), "user_id").alias("name"), F.col("user_id").alias("cardId")).alias("driver"),
        F.col("props").alias("description"), value.alias("newValue"), F.struct(kind.alias("name")).alias("rule"),
        F.array(kind.cast("variant"), F.lit(1).cast("variant")).alias("rulesList"), F.lit("?").alias("seconds"),
    )
    pages = landed(table(spark, folder, "events"), "event_id", wrapped("event_id", record))
    return plain_names(without_zone(bronze.bronze_table(pages, "notifications", max_pages=None), "eventDate"))


def reminders_sql() -> str:
    given = {
        "ID": "c_custkey", "NOME_VEICULO": "c_name", "closed": "CASE WHEN c_nationkey > 20 THEN 'sim' WHEN c_nationkey > 12 THEN 'true' ELSE 'false' END",
        "ID_VEICULO": "c_custkey * 10 + i", "MODELO": "CASE WHEN i IS NOT NULL THEN c_mktsegment END",
        "MARCA/MODELO": "CASE WHEN i IS NOT NULL THEN c_mktsegment || ' ' || i END", "PLACA": "CASE WHEN i IS NOT NULL THEN 'P' || i END",
        "tankSize": "CASE WHEN i IS NOT NULL THEN c_acctbal END", "id.2": "c_custkey * 100 + j", "id.3": "CAST(j AS BIGINT)",
        "TIPO_MANUTENCAO": "CASE WHEN j IS NOT NULL THEN 'kind ' || j END", "ODEMETRO_GAP": "CASE WHEN j IS NOT NULL THEN c_acctbal END",
    }
    types = {"tankSize": "DOUBLE", "INTERVALO_GAP": "DOUBLE", "ODEMETRO_GAP": "DOUBLE", "hourmeterGap": "DOUBLE", "intervalType": "DOUBLE",
             "odometerThreshold": "DOUBLE", "hourmeterThreshold": "DOUBLE", "timeThreshold": "DOUBLE", "thresholdIntervalType": "DOUBLE"}
    columns = [f'CAST({given.get(c, "NULL")} AS {types.get(c, "VARCHAR")}) AS "{plain_name(c)}"' for c in MAINTENANCE_REMINDERS.order]
    return f"""SELECT {', '.join(columns)} FROM customer
    LEFT JOIN (VALUES (1), (2), (3)) v(i) ON i <= c_nationkey % 4
    LEFT JOIN (VALUES (1), (2)) w(j) ON j <= (c_nationkey + 1) % 3"""


@query("bronze_maintenance_reminders", "M6 C5 C6 C8 E9", reminders_sql())
def bronze_maintenance_reminders(spark, folder):
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    vehicles = [
        F.struct((key * 10 + i).alias("id"), F.col("c_mktsegment").alias("make"), F.concat("c_mktsegment", F.lit(f" {i}")).alias("model"),
                 F.lit(f"P{i}").alias("code"), F.col("c_acctbal").alias("tankSize"))
        for i in (1, 2, 3)
    ]
    items = [
        F.struct((key * 100 + j).alias("id"), F.struct(F.lit(j).alias("id"), F.lit(f"kind {j}").alias("name")).alias("payable"),
                 F.col("c_acctbal").cast("string").alias("odometerGap"), F.lit("-").alias("intervalGap"))
        for j in (1, 2)
    ]
    # Without vehicles the list is empty for some customers and absent for others.
    chosen = F.when(nation != 24, F.slice(F.array(*vehicles), 1, nation % 4))
    record = F.struct(
        key.alias("id"), F.col("c_name").alias("name"), F.when(nation > 20, F.lit("sim").cast("variant")).otherwise((nation > 12).cast("variant")).alias("closed"), chosen.alias("vehicles"),
        F.slice(F.array(*items), 1, (nation + 1) % 3).alias("reminderItems"),
    )
    pages = landed(table(spark, folder, "customer"), "c_custkey", wrapped("c_custkey", record))
    reminders = plain_names(bronze.bronze_table(pages, "maintenance_reminders", max_pages=None))
    return reminders.withColumn("tankSize", F.col("tankSize").cast("double"))  # its text may be 5 or 5.0


def results_sql() -> str:
    odd = "p_partkey % 2 = 1"
    given = {
        "reminderItem": """'{"id":' || p_partkey || '}'""", "vehicle": "p_brand", "nextOdometer": "p_retailprice", "nextDate": "'soon'",
        "lastMaintenanceId": "'M/' || p_partkey", "isDueSoon": "CASE WHEN p_size > 40 THEN 'yes' WHEN p_size > 25 THEN 'true' ELSE 'false' END",
    }
    types = {"nextOdometer": "DOUBLE"}
    columns = [
        f'CAST(CASE WHEN {odd} THEN {given.get(n, "NULL")} END AS {types.get(n, "VARCHAR")}) AS "row_{n}"'
        for n in ENDPOINTS["maintenance_results"].fields
    ]
    return f"SELECT {', '.join(columns)} FROM part"


@query("bronze_maintenance_results", "M7 C2 C9", results_sql())
def bronze_maintenance_results(spark, folder):
    record = F.struct(
        F.struct(F.col("p_partkey").alias("id")).alias("reminderItem"), F.col("p_brand").alias("vehicle"),
        F.col("p_retailprice").alias("nextOdometer"), F.lit("soon").alias("nextDate"),
        F.concat(F.lit("M/"), "p_partkey").alias("lastMaintenanceId"),
        F.when(F.col("p_size") > 40, F.lit("yes").cast("variant")).otherwise((F.col("p_size") > 25).cast("variant")).alias("isDueSoon"),
    )
    pages = landed(table(spark, folder, "part"), "p_partkey", wrapped("p_partkey", record))
    results = plain_names(bronze.bronze_table(pages, "maintenance_results", max_pages=None))
    return results.withColumn("row_nextOdometer", F.col("row_nextOdometer").cast("double"))
