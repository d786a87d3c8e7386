"""Readers, writers and the bronze, silver and gold jobs."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quaylake import session
from quaylake.plans import bronze, endpoints, gold, silver
from quaylake.sources import readers, writers

NOON = datetime(2024, 2, 1, 12)


def rows(df):
    return [tuple(r) for r in df.collect()]


def write_lines(spark, folder, name, lines):
    """One text file with a given name."""
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/raw-{name}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    part = [f.getPath() for f in fs.listStatus(hadoop.Path(f"{folder}/raw-{name}")) if f.getPath().getName().startswith("part-")]
    if part:
        hadoop.FileUtil.copy(fs, part[0], fs, hadoop.Path(f"{folder}/in/{name}"), False, spark._jsc.hadoopConfiguration())
    else:
        fs.create(hadoop.Path(f"{folder}/in/{name}")).close()
    return f"{folder}/in/{name}"


CSV = ["id,document,amount,note", "1,007,1.5,NULL", '2,NULL,2.5,"{""k"": ""a,b""}"', "3,12,,"]


def test_csv_null_text(spark, folder):
    path = write_lines(spark, folder, "a.csv", CSV)
    kept = readers.csv_table(spark, path)
    assert rows(kept) == [(1, "007", 1.5, "NULL"), (2, "NULL", 2.5, '{"k": "a,b"}'), (3, "12", None, None)]
    read = readers.csv_table(spark, path, readers.NULL_TEXT)
    assert rows(read) == [(1, 7, 1.5, None), (2, None, 2.5, '{"k": "a,b"}'), (3, 12, None, None)]
    named = readers.csv_table(spark, path, readers.NULL_TEXT, "id int, document string, amount double, note string")
    assert [r["document"] for r in named.collect()] == ["007", None, "12"]


@pytest.mark.parametrize("lines", [["a,b", "1,2", "3"], ["a,b", "1,2", "4,5,6"], ["a,b", '1,"x', 'y"']])
@pytest.mark.parametrize("missing", [None, readers.MISSING_TEXTS])
def test_csv_with_ragged_lines_fails(spark, folder, lines, missing):
    path = write_lines(spark, folder, "a.csv", lines)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        readers.csv_table(spark, path, missing).collect()
    assert len(readers.csv_table(spark, path, missing, strict=False).collect()) >= 2


def test_csv_line_breaks_inside_quotes(spark, folder):
    df = spark.createDataFrame([(1, 'a\nb"c'), (2, None)], "id int, note string")
    writers.export_csv(df, folder)
    assert sorted(rows(readers.csv_table(spark, folder, multi_line=True))) == [(1, 'a\nb"c'), (2, None)]


def test_csv_spellings_of_missing_values(spark, folder):
    path = write_lines(spark, folder, "a.csv", ["n,x,t,d,e", "1,1.5,NA,2024-01-02,", "N/A,None,y,nan,null", "12345678901,2,z,2024-01-03,NaN"])
    got = readers.csv_table(spark, path, readers.MISSING_TEXTS)
    assert [kind for _, kind in got.dtypes] == ["bigint", "double", "string", "date", "string"]
    assert rows(got) == [
        (1, 1.5, None, date(2024, 1, 2), None), (None, None, "y", None, None), (12345678901, 2.0, "z", date(2024, 1, 3), None),
    ]
    named = readers.csv_table(spark, path, readers.MISSING_TEXTS, "n bigint, x double, t string, d date, e string")
    assert rows(named) == rows(got)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.csv_table(spark, path, readers.MISSING_TEXTS, "n bigint, x double, t int, d date, e string").collect()


def test_csv_folder_without_files(spark, folder):
    write_lines(spark, folder, "no.txt", ["q"])
    assert rows(readers.csv_folder(spark, f"{folder}/in").report()) == []
    write_lines(spark, folder, "empty.csv", [])
    assert rows(readers.csv_folder(spark, f"{folder}/in").report()) == []


def test_files_of_one_name_in_two_folders(spark, folder):
    for part, lines in (("p=1", ["x" * 9]), ("p=2", ["x" * 19])):
        write_lines(spark, f"{folder}/{part}", "data-1.csv", lines)
    got = rows(readers.file_listing(spark, f"{folder}/*/in", "*.csv"))
    assert sorted(got) == [("data-1.csv", 10), ("data-1.csv", 20)]


def test_only_queries_run_and_views_come_back(spark, folder):
    spark.range(3).createOrReplaceTempView("mine")
    writers.replace_table(spark.range(2), "kept_table", folder)
    given = {"mine": spark.range(7), "other": spark.range(1)}
    assert readers.query(spark, "WITH x AS (SELECT * FROM mine) SELECT count(*) FROM x; ", given).first()[0] == 7
    for text in ("DROP TABLE kept_table", "INSERT INTO kept_table SELECT 1", "SET a = 1", "CREATE TABLE t AS SELECT 1"):
        with pytest.raises(Exception):
            readers.query(spark, text, given).collect()
    assert spark.table("mine").count() == 3 and spark.table("kept_table").count() == 2
    assert not spark.catalog.tableExists("other")
    spark.sql("DROP TABLE kept_table")


def test_csv_folder_goes_on_after_a_bad_file(spark, folder):
    write_lines(spark, folder, "b.csv", ["x,y", "1,2", "3,4"])
    write_lines(spark, folder, "a.csv", CSV)
    write_lines(spark, folder, "empty.csv", [])
    write_lines(spark, folder, "no.txt", ["q"])
    loaded = readers.csv_folder(spark, f"{folder}/in")
    assert list(loaded.frames) == ["a.csv", "b.csv"]
    assert list(loaded.errors) == ["empty.csv"]
    assert rows(loaded.report()) == [("a.csv", 3, "id, document, amount, note"), ("b.csv", 2, "x, y")]


def test_csv_folder_notes_ragged_files_and_quoted_breaks(spark, folder):
    write_lines(spark, folder, "good.csv", ["x,y", "1,2", "3,4"])
    write_lines(spark, folder, "head.csv", ["x,y"])
    write_lines(spark, folder, "long.csv", ["x,y", "1,2", "3,4,5", "6,7", "8"])
    write_lines(spark, folder, "quoted.csv", ["x,y", '1,"a', 'b"', '2,"c ""d"" e"'])
    write_lines(spark, folder, "single.csv", ["x", '"a', 'b"'])
    write_lines(spark, folder, "typed.csv", ["x,y", "1,2", "no,4"])
    schemas = {"typed.csv": "x int, y int"}
    loaded = readers.csv_folder(spark, f"{folder}/in", schemas=schemas)
    assert rows(loaded.report()) == [("good.csv", 2, "x, y"), ("head.csv", 0, "x, y")]
    assert sorted(loaded.errors) == ["long.csv", "quoted.csv", "single.csv", "typed.csv"]
    assert loaded.errors["long.csv"].startswith("row 2 doesn't fit the columns, 2 of 4")
    assert loaded.errors["typed.csv"].startswith("row 2 doesn't fit the columns, 1 of 2")
    assert loaded["good.csv"].count() == 2
    whole = readers.csv_folder(spark, f"{folder}/in", schemas=schemas, multi_line=True)
    assert sorted(whole.errors) == ["long.csv", "typed.csv"]
    assert [(r[0], r[1]) for r in rows(whole.report())] == [("good.csv", 2), ("head.csv", 0), ("quoted.csv", 2), ("single.csv", 1)]
    assert whole["quoted.csv"].count() == 2
    loose = readers.csv_folder(spark, f"{folder}/in", strict=False)
    assert loose.errors == {} and loose.rows["long.csv"] == 4


def test_first_misfit_of_a_file_of_many_blocks(spark, folder):
    path = write_lines(spark, folder, "a.csv", ["x,y", *[f"{i},{i}" for i in range(1, 5000)], "1,2,3", *["5,6"] * 900, "7"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    found = rows(readers.fitting(spark, [path], ["string", "string"], None, False).select("rows", "bad", "first"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(5901, 2, 5000)]


def test_file_listings(spark, folder):
    write_lines(spark, folder, "data-1.csv", ["x" * 2047])
    write_lines(spark, folder, "df_2.csv", ["x" * 99])
    write_lines(spark, folder, "z.csv", [])
    got = rows(readers.file_inventory(spark, f"{folder}/in"))
    assert got == [("CSV Original", "data-1.csv", 2.0), ("DataFrame Exportado", "df_2.csv", 0.1), ("Outro", "z.csv", 0.0)]
    wanted = readers.expected_files(spark, f"{folder}/in", ["z.csv", "gone.html"]).orderBy("file")
    assert [(r["file"], r["exists"]) for r in wanted.collect()] == [("gone.html", False), ("z.csv", True)]


def test_jdbc_options(spark, monkeypatch):
    """No database is started: what would be asked of the reader is recorded instead."""
    asked = []

    class Reader:
        def jdbc(self, url, table, **options):
            asked.append((table, options))
            return spark.createDataFrame([(3, 90)], "low int, high int")

    class Session:
        read = Reader()

    readers.jdbc_table(Session(), "jdbc:x", "dbo.t")
    readers.jdbc_table(Session(), "jdbc:x", "dbo.t", {"user": "u"}, "id", 8)
    readers.jdbc_table(Session(), "jdbc:x", "dbo.t", predicates=["a = 1", "a <> 1 OR a IS NULL"])
    assert asked[0] == ("dbo.t", {"properties": {"fetchsize": "10000"}})
    assert "MIN(id)" in asked[1][0] and "MAX(id)" in asked[1][0]
    assert asked[2][1] == {
        "column": "id", "lowerBound": "3", "upperBound": "90", "numPartitions": 8,
        "properties": {"fetchsize": "10000", "user": "u"},
    }
    assert asked[3][1]["predicates"] == ["a = 1", "a <> 1 OR a IS NULL"]


def test_query_takes_values_as_parameters(spark):
    df = spark.createDataFrame([("it's", 1), ("x", 2)], "name string, n int")
    got = readers.query(spark, "SELECT n FROM things WHERE name = :name", {"things": df}, {"name": "it's"})
    assert rows(got) == [(1,)]


def test_landing_keeps_the_old_table_when_there_is_nothing_new(spark, folder):
    df = spark.createDataFrame([(1,)], "id int")
    assert writers.land(df, folder, NOON)
    assert not writers.land(df.filter("id > 1"), folder, datetime(2025, 1, 1))
    assert rows(spark.read.parquet(folder)) == [(1, "2024-02-01T12:00:00+00:00", "2024-02-01")]
    assert writers.land(spark.createDataFrame([(2,)], "id int"), folder, NOON)
    assert [r["id"] for r in spark.read.parquet(folder).collect()] == [2]


def failing(spark):
    return spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("id"))


def test_a_failed_write_keeps_the_old_table(spark, folder):
    path = f"{folder}/table"
    writers.overwrite_parquet(spark.createDataFrame([(1,)], "id int"), path)
    for write in (writers.overwrite_parquet, writers.overwrite_if_any, writers.land):
        with pytest.raises(Exception, match="lost"):
            write(failing(spark), path)
    assert rows(spark.read.parquet(path)) == [(1,)]
    files, place = session.file_system(spark, folder)
    assert [f.getPath().getName() for f in files.listStatus(place)] == ["table"]


def test_a_failed_move_puts_the_old_table_back(spark, folder, monkeypatch):
    path = f"{folder}/table"
    writers.overwrite_parquet(spark.createDataFrame([(1,)], "id int"), path)

    def refuse(spark, source, to):
        if "__new" in source:
            raise OSError("refused")
        return session.moved(spark, source, to)

    monkeypatch.setattr(writers, "moved", refuse)
    with pytest.raises(OSError):
        writers.overwrite_parquet(spark.createDataFrame([(2,)], "id int"), path)
    assert rows(spark.read.parquet(path)) == [(1,)]


def test_a_table_may_be_replaced_by_rows_of_itself(spark, folder):
    writers.overwrite_parquet(spark.range(3).toDF("id"), folder + "/t")
    writers.overwrite_parquet(spark.read.parquet(folder + "/t").where("id > 0"), folder + "/t")
    assert spark.read.parquet(folder + "/t").count() == 2


def test_a_source_is_read_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(0, 10, 1, 2).mapInArrow(count, "id long")
    assert writers.write_snapshot(source, folder, NOON) is not None
    assert seen.value == 10


def test_history_has_the_columns_of_all_snapshots(spark, folder):
    bronze.database_snapshot(spark.range(2), folder, datetime(2024, 2, 1, 1))
    bronze.database_snapshot(spark.range(1).withColumn("added", F.lit("x")), folder, datetime(2024, 2, 1, 2))
    got = bronze.retained_history(spark, folder).select("id", "added", "snapshot_ts")
    assert sorted(rows(got), key=repr) == [
        (0, "x", "20240201_020000"), (0, None, "20240201_010000"), (1, None, "20240201_010000"),
    ]


def test_a_failed_rename_keeps_the_old_catalog_table(spark, folder, monkeypatch):
    writers.swap_table(spark.range(3).toDF("id"), "swap_fails", f"{folder}/1")
    run = type(spark).sql

    def refuse(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE swap_fails__new_"):
            raise RuntimeError("refused")
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", refuse)
    with pytest.raises(RuntimeError):
        writers.swap_table(spark.range(9).toDF("id"), "swap_fails", f"{folder}/2")
    monkeypatch.undo()
    assert spark.table("swap_fails").count() == 3
    spark.sql("DROP TABLE swap_fails")


def test_stored_view(spark, folder):
    writers.replace_table(spark.range(4), "view_source", f"{folder}/s")
    assert writers.store_view(spark, "stored_view", "SELECT id FROM view_source WHERE id > 1").count() == 2
    assert spark.newSession().table("stored_view").count() == 2
    spark.sql("DROP VIEW stored_view")
    spark.sql("DROP TABLE view_source")


def test_snapshots(spark, folder):
    assert bronze.database_snapshot(spark.createDataFrame([], "id int"), folder, NOON) == (None, None)
    for hour in range(7):
        df = spark.range(hour + 1).withColumn("note", F.lit(None).cast("string"))
        label, summary = bronze.database_snapshot(df, folder, datetime(2024, 2, 1, hour))
        assert label == f"20240201_0{hour}0000"
        assert summary.first()["null_counts"] == {"id": 0, "note": hour + 1}
    bronze.database_snapshot(spark.range(9).withColumn("note", F.lit("x")), folder, datetime(2024, 2, 1, 6))
    counts = bronze.retained_history(spark, folder).groupBy("snapshot_ts").count().orderBy("snapshot_ts")
    assert rows(counts) == [(f"20240201_0{h}0000", n) for h, n in [(2, 3), (3, 4), (4, 5), (5, 6), (6, 9)]]
    assert spark.read.parquet(f"{folder}/latest").count() == 9


def test_retention_reads_only_the_newest_folders(spark, folder):
    for hour in range(3):
        writers.write_snapshot(spark.range(2), folder, datetime(2024, 2, 1, hour))
    plan = bronze.retained_history(spark, folder, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_ts" in plan


def test_table_swap_reads_the_table_it_replaces(spark, folder):
    first = writers.swap_table(spark.range(3).toDF("id"), "swap_me", f"{folder}/1")
    second = writers.swap_table(first.withColumn("id", F.col("id") + 10), "swap_me", f"{folder}/2")
    assert sorted(rows(second)) == [(10,), (11,), (12,)]
    assert not spark.catalog.tableExists("swap_me__tmp")


def test_gold_summary(spark, folder):
    writers.replace_table(spark.range(7), gold.SALES_SOURCE, f"{folder}/source")
    schema = spark.catalog.currentDatabase()
    got = gold.build_sales_summary(spark, schema, date(2024, 1, 2), "summary_test", f"{folder}/gold")
    assert got.columns == ["data_referencia", "qtd_linhas_pcnfsaid"]
    assert rows(got) == [(date(2024, 1, 2), 7)]
    assert spark.table(f"stg_{gold.SALES_SOURCE}").count() == 7


def test_csv_export_is_read_back_in_order(spark, folder):
    df = spark.createDataFrame([(2, 'say "hi", you'), (1, None)], "id int, note string")
    writers.export_csv(df.orderBy("id"), folder, one_file=True)
    assert rows(readers.csv_table(spark, folder)) == [(1, None), (2, 'say "hi", you')]


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), Context(master)

    for master in ("spark://cluster", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_root(Session(master))


def test_broadcast_is_measured(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "a string")
    assert session.fits_broadcast(df, 10_000)
    assert not session.fits_broadcast(df, 1000)
    assert session.fits_broadcast(df.limit(0), 0)


# Bronze


def pages(spark, *payloads):
    return spark.createDataFrame([(i + 1, 200, json.dumps(p)) for i, p in enumerate(payloads)], "page int, status int, payload string")


def test_bronze_columns(spark):
    empty = pages(spark, {"content": []})
    widths = {name: len(bronze.bronze_table(empty, name).columns) for name in endpoints.ENDPOINTS}
    assert widths == {
        "vehicles": 5, "contact_drivers": 20, "vehicle_daily": 25, "notifications": 20,
        "maintenance_reminders": 35, "maintenance_results": 22,
    }
    reminders = bronze.bronze_table(empty, "maintenance_reminders")
    assert reminders.columns == list(endpoints.MAINTENANCE_REMINDERS.order)


def test_bronze_reminders(spark):
    records = [
        {"row": {"id": 1, "name": "n", "closed": True, "vehicles": [{"id": 5, "make": "m", "model": "k"}, 3, None],
                 "reminderItems": [{"id": 7, "payable": {"id": 9, "name": "oil"}, "odometerGap": "x", "intervalGap": 2}]}},
        {"id": 2, "vehicles": [], "reminderItems": None},
        {"id": 3, "vehicles": "none", "reminderItems": [{"id": 8, "payable": 4}]},
    ]
    got = bronze.bronze_table(pages(spark, records), "maintenance_reminders").select(
        "ID", "ID_VEICULO", "MODELO", "`MARCA/MODELO`", "`id.2`", "`id.3`", "TIPO_MANUTENCAO", "ODEMETRO_GAP", "INTERVALO_GAP"
    )
    assert rows(got) == [
        ("1", "5", "m", "k", "7", "9", "oil", None, 2.0),
        ("1", None, None, None, "7", "9", "oil", None, 2.0),
        ("1", None, None, None, "7", "9", "oil", None, 2.0),
        ("2", None, None, None, None, None, None, None, None),
        ("3", None, None, None, "8", None, None, None, None),
    ]


def test_bronze_keeps_values_as_they_are(spark):
    data = pages(spark, [{"id": "V-1"}, {"id": 1.5}, {"id": 7}])
    assert sorted(rows(bronze.bronze_table(data, "vehicles").select("ID_VEICULO"))) == [("1.5",), ("7",), ("V-1",)]
    narrowed = bronze.bronze_table(data, "vehicles", types={"id": "bigint"}).select("ID_VEICULO")
    assert sorted(rows(narrowed), key=repr) == [(1,), (7,), (None,)]
    results = pages(spark, [{"row": {"isDueSoon": "yes", "startOdometer": "12 km", "lastMaintenanceId": "a/1"}}])
    kept = bronze.bronze_table(results, "maintenance_results").select("`row.isDueSoon`", "`row.startOdometer`", "`row.lastMaintenanceId`")
    assert rows(kept) == [("yes", "12 km", "a/1")]


def test_flags_days_and_numbers_of_a_day(spark):
    data = pages(spark, [
        {"date": "2024-01-01T22:00:00-03:00", "ignitionOn": True, "ignitionOff": False, "maxSpeed": "true", "meanSpeed": "1e2"},
        {"date": "2024-01-01T01:00:00+09:00", "ignitionOn": None, "ignitionOff": {"a": 1}, "maxSpeed": "12 km", "meanSpeed": 7},
    ])
    got = bronze.bronze_table(data, "vehicle_daily").select("date", "ignitionOn", "ignitionOff", "maxSpeed", "meanSpeed")
    assert rows(got) == [(date(2024, 1, 1), 1.0, 0.0, None, 100.0), (date(2024, 1, 1), None, None, None, 7.0)]


def test_driver_journeys(spark):
    records = [
        {"driver": {"id": 1, "name": "n"}, "vehicle": 3, "enterTime": "2024-01-02T03:04:05Z", "duration": 90, "extra": {"a": [1]}},
        {"driver": None, "leaveTime": "bad", "distance": 1500, "tail": 1},
    ]
    got = bronze.driver_journeys(pages(spark, {"data": records}))
    assert set(got.columns) == {
        "enterTime", "leaveTime", "duration", "distance", "extra", "tail", "motorista_id", "motorista_nome",
        "veiculo_id", "veiculo_codigo", "entrada", "saida", "duracao_minutos", "distancia_km",
    }
    some = got.select("motorista_id", "veiculo_codigo", F.col("entrada").cast("timestamp_ntz"), "saida", "duracao_minutos", "distancia_km")
    assert rows(some) == [(1, None, datetime(2024, 1, 2, 3, 4, 5), None, 1.5, None), (None, None, None, None, None, 1.5)]


def test_landed_endpoint(spark, folder):
    data = pages(spark, {"content": [{"row": {"id": 1, "code": "c"}}]})
    assert bronze.land_endpoint(data, "vehicles", folder, NOON)
    assert not bronze.land_endpoint(pages(spark, {"content": []}), "vehicles", folder, NOON)
    assert rows(spark.read.parquet(folder)) == [("1", "c", None, None, None, "2024-02-01T12:00:00+00:00", "2024-02-01")]


# Silver


def invoice(**given):
    names = [*silver.INVOICE_TYPES, *silver.INVOICE_MEASURES, *silver.INVOICE_TEXTS, "_ingestion_ts_utc", "_ingestion_date"]
    row = dict.fromkeys(names)
    row |= {"codfilial": "1", "data_faturamento": "2024-01-02", "numnota": "3", "codigo": "4", "codcli": "5"}
    return {**row, **given}


def invoices(spark, *given):
    schema = ", ".join(f"`{name}` string" for name in invoice())
    return spark.createDataFrame([tuple(r.values()) for r in given], schema)


def test_silver_invoices(spark):
    bronze_rows = invoices(
        spark,
        invoice(cliente=" a ", qtd="1.5", _ingestion_ts_utc="2024-01-02T03:04:05.678+00:00"),
        invoice(cliente="a", qtd="1.500000", _ingestion_ts_utc="2024-01-02T03:04:05"),
        invoice(cliente="  "),
        invoice(cliente=None),
        *[invoice(**{key: None}) for key in silver.INVOICE_KEYS],
    )
    got = silver.invoices(bronze_rows, NOON)
    assert len(got.columns) == 55
    kept = got.select("cliente", "qtd", F.col("_ingestion_ts_utc").cast("string"), F.col("_silver_ts_utc").cast("string"))
    assert sorted(rows(kept), key=repr) == [
        ("a", Decimal("1.500000"), "2024-01-02 03:04:05", "2024-02-01 12:00:00"),
        (None, None, None, "2024-02-01 12:00:00"),
    ]


def test_silver_fails_on_a_bad_value(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.invoices(invoices(spark, invoice(mes="janeiro")), NOON).collect()


def test_silver_keys_are_filtered_in_the_scan(spark, folder):
    invoices(spark, invoice()).write.parquet(folder)
    plan = silver.invoices(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert all(f"IsNotNull({key})" in plan for key in silver.INVOICE_KEYS)


def test_silver_supervisors(spark):
    schema = ", ".join(f"`{name}` string" for name in [*silver.SUPERVISOR_TYPES, "other"])
    row = ("2024-01-02", None, "1.5", None, None, "1", None, None, "7", None, "2024-01-02T03:04:05", "2024-01-02")
    got = silver.supervisors(spark.createDataFrame([(*row, "x"), (*row, "y")], schema))
    assert got.count() == 1 and len(got.columns) == 12
    assert got.first()["vllimcred"] == 7
