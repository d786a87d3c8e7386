"""Inputs for the operators, derived by Spark from the given tables, whole tables each time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.registry.base import table
from quaylake.session import new_folder
from quaylake.sources.writers import overwrite_parquet

RECORDS_PER_PAGE = 500

# Pages that this session has landed, by their plan: asked for again they are read, not written.
LANDED: dict[tuple[str, int], str] = {}


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the shape of a reconciliation table; some suppliers, reasons and scores are null."""
    state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("run-"), F.year("o_orderdate")).alias("run_id"),
        F.when(state == "F", "MATCHED").when(state == "O", "UNMATCHED").otherwise("UNMATCHED_MOVEMENT").alias("status"),
        F.when(state == "F", "PAID").when(state == "O", "OPEN").otherwise("MOVEMENT").alias("source"),
        F.when(state != "P", F.concat(F.lit("Supplier "), "o_custkey")).alias("supplier"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("created_at"),
        F.when(priority != "4-NOT SPECIFIED", priority).alias("match_reason"),
        F.when(priority == "1-URGENT", 10).when(priority == "2-HIGH", 8).when(priority == "3-MEDIUM", 5)
        .cast("bigint").alias("match_score"),
    )


RECONCILIATION_SQL = """
WITH conciliacoes AS (
  SELECT o_orderkey AS id,
         'run-' || year(o_orderdate) AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'MATCHED' WHEN 'O' THEN 'UNMATCHED' ELSE 'UNMATCHED_MOVEMENT' END AS status,
         CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'OPEN' ELSE 'MOVEMENT' END AS source,
         CASE WHEN o_orderstatus <> 'P' THEN 'Supplier ' || o_custkey END AS supplier,
         o_totalprice AS amount,
         o_orderdate AS created_at,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS match_reason,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 8 WHEN '3-MEDIUM' THEN 5 END AS BIGINT) AS match_score
  FROM orders
)
"""


def page_of(key: str) -> Column:
    return (F.floor(F.col(key) / RECORDS_PER_PAGE) + 1).cast("int")


def wrapped(key: str, record: Column) -> Column:
    """JSON text of a record; every other one stands in a `row` member. Null fields are absent."""
    return F.when(F.col(key) % 2 == 1, F.to_json(F.struct(record.alias("row")))).otherwise(F.to_json(record))


def landed(
    rows: DataFrame, key: str, record: Column, page: Column | None = None, runs: dict[str, Column] | None = None,
    status: Column | None = None,
) -> DataFrame:
    """Pages of JSON texts, all under `content`, landed in the shared folder. The key is unique
    and gives the page, so a page gathers at most RECORDS_PER_PAGE texts."""
    groups = [c.alias(name) for name, c in (runs or {}).items()]
    number = (page if page is not None else page_of(key)).alias("page")
    answered = (status if status is not None else F.lit(200)).cast("int")
    content = F.concat(F.lit('{"content":['), F.array_join(F.collect_list(record), ","), F.lit("]}"))
    pages = rows.groupBy(*groups, number).agg(answered.alias("status"), content.alias("payload"))
    spark = rows.sparkSession
    known = (spark.sparkContext.applicationId, pages.semanticHash())
    if known not in LANDED:
        path = new_folder(spark, "pages")
        overwrite_parquet(pages, path)
        LANDED[known] = path
    return spark.read.parquet(LANDED[known])


def order_runs(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, Column], Column]:
    """Orders in runs of twenty pages."""
    run = F.floor(F.col("o_orderkey") / 10000).cast("int")
    page = (F.floor(F.col("o_orderkey") / RECORDS_PER_PAGE) - run * 20 + 1).cast("int")
    return table(spark, folder, "orders"), {"run": run}, page


ORDER_RUNS_SQL = """
WITH placed AS (
  SELECT *, CAST(o_orderkey // 10000 AS INTEGER) AS run,
         CAST(o_orderkey // 500 - (o_orderkey // 10000) * 20 + 1 AS INTEGER) AS page
  FROM orders
)
"""


def listing_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as the lines of a dump listing. One brand's name may be the beginning of another's."""
    brand, noun = F.col("p_brand"), F.element_at(F.split("p_name", " "), -1)
    kind = F.col("p_type")
    text = (
        F.when(kind == "ECONOMY", F.concat(F.lit("TABLE public "), brand))
        .when(kind == "STANDARD", F.concat(F.lit("TABLE DATA public "), brand))
        .when(kind == "MEDIUM", F.concat(F.lit("INDEX public "), brand, F.lit("_"), noun, F.lit("_idx")))
        .when(kind == "PROMO", F.concat(F.lit("FK CONSTRAINT public "), noun, F.lit(" "), noun, F.lit("_"), brand, F.lit("_fk")))
        .when(kind == "LARGE", F.concat(F.lit("CONSTRAINT public "), brand, F.lit(" "), brand, F.lit("_pkey")))
        .otherwise(F.concat(F.lit("SEQUENCE public "), brand, F.lit("_seq")))
    )
    line = F.concat_ws(" ", F.concat("p_partkey", F.lit(";")), F.lit("1259"), "p_size", text, F.lit("owner"))
    return table(spark, folder, "part").select(F.col("p_partkey").alias("n"), line.alias("value"))


LISTING_SQL = """
WITH lines AS (
  SELECT p_partkey AS n,
         p_partkey || '; 1259 ' || p_size || ' ' ||
         CASE p_type
           WHEN 'ECONOMY' THEN 'TABLE public ' || p_brand
           WHEN 'STANDARD' THEN 'TABLE DATA public ' || p_brand
           WHEN 'MEDIUM' THEN 'INDEX public ' || p_brand || '_' || split_part(p_name, ' ', 2) || '_idx'
           WHEN 'PROMO' THEN 'FK CONSTRAINT public ' || split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 2) || '_' || p_brand || '_fk'
           WHEN 'LARGE' THEN 'CONSTRAINT public ' || p_brand || ' ' || p_brand || '_pkey'
           ELSE 'SEQUENCE public ' || p_brand || '_seq'
         END || ' owner' AS value
  FROM part
), names AS (
  SELECT DISTINCT string_split(value, ' ')[-2] AS name FROM lines
  WHERE contains(value, 'TABLE public ') AND NOT contains(value, 'TABLE DATA')
)
"""
