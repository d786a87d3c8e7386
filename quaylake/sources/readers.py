"""Where tables come from: CSV, Parquet, the catalog, databases, text and file listings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions.casting import quoted
from quaylake.functions.measures import kilobytes, megabytes
from quaylake.functions.text import prefix_category

# Fixed value: how the exports write a missing value.
NULL_TEXT = "NULL"

# Spellings of a missing value that table readers commonly take.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Kinds of CSV by file name.
FILE_KINDS = (("data-", "CSV Original"), ("df_", "DataFrame Exportado"))
OTHER_FILE = "Outro"


def csv_table(
    spark: SparkSession,
    path: str | Sequence[str],
    null_text: str | Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    strict: bool = True,
) -> DataFrame:
    """CSV with a header line; quotes inside a field are doubled.

    Types are inferred unless a schema is given: inferring reads the files once more, so name
    the schema of large ones. `null_text` is read as null (`NULL_TEXT` for exports), or a list of
    spellings such as `MISSING_TEXTS`, which go before any type is looked for; left out, such a text
    stays a string, as the SQL engine has it.

    `multi_line` is for line breaks inside quotes; files are not split then. A line with more or
    fewer fields than the header, or a value that doesn't fit a given schema, fails the read;
    `strict=False` fills up and cuts off as Spark does.
    """
    spellings = [null_text] if isinstance(null_text, str) else list(null_text or [])
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if len(spellings) == 1:
        reader = reader.option("nullValue", spellings[0])
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if len(spellings) > 1:
        texts = reader.csv(path).schema if wanted is None else wanted
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in texts.fields])
    elif wanted is None:
        texts = wanted = reader.option("inferSchema", True).csv(path).schema
    else:
        texts = wanted
    if not texts.fields:
        return reader.csv(path)
    reader = reader.option("inferSchema", False).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    read = reader.schema(texts).csv(path)
    return read if len(spellings) < 2 else typed(without_texts(read, spellings), wanted, strict)


def without_texts(df: DataFrame, spellings: Sequence[str]) -> DataFrame:
    """Text columns with the spellings of a missing value as null."""
    return df.select(*[F.when(~quoted(c).isin(*spellings), quoted(c)).alias(c) for c in df.columns])


# The types that are tried for a column of texts, the first that takes every value.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def typed(df: DataFrame, schema: T.StructType | None, strict: bool = True) -> DataFrame:
    """Text columns cast to a schema, or each to the first of `INFERRED` that takes all its values,
    for which one aggregation runs."""
    if schema is None:
        misfits = [
            F.count_if(quoted(c).isNotNull() & quoted(c).try_cast(kind).isNull()).alias(f"{kind}{i}")
            for i, c in enumerate(df.columns) for kind in INFERRED
        ]
        filled = [F.count(quoted(c)).alias(f"filled{i}") for i, c in enumerate(df.columns)]
        found = df.agg(*misfits, *filled).first()
        kinds = [
            next((k for k in INFERRED if found[f"filled{i}"] and not found[f"{k}{i}"]), "string")
            for i in range(len(df.columns))
        ]
    else:
        kinds = [f.dataType.simpleString() for f in schema.fields]
    cast = [quoted(c).cast(k) if strict else quoted(c).try_cast(k) for c, k in zip(df.columns, kinds)]
    return df.select(*[value.alias(c) for value, c in zip(cast, df.columns)])


class CsvFolder(Mapping):
    """Frames by file name, each made when it is asked for; `errors` has the files that can't be read
    with the reason, `headers` the columns of the others and `rows` how many they have."""

    def __init__(self, spark: SparkSession, folder: str, **options) -> None:
        self.spark, self.folder, self.options = spark, folder, options
        self.headers: dict[str, list[str]] = {}
        self.rows: dict[str, int] = {}
        self.errors: dict[str, str] = {}

    @property
    def frames(self) -> CsvFolder:
        return self

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.headers:
            raise KeyError(name)
        options = {k: v for k, v in self.options.items() if k != "schemas"}
        return csv_table(self.spark, f"{self.folder}/{name}", schema=(self.options.get("schemas") or {}).get(name), **options)

    def __iter__(self):
        return iter(self.headers)

    def __len__(self) -> int:
        return len(self.headers)

    def report(self) -> DataFrame:
        """File, rows and columns of every readable file, by name."""
        found = [(name, self.rows[name], ", ".join(columns)) for name, columns in self.headers.items()]
        return self.spark.createDataFrame(found, "file string, rows bigint, columns string").orderBy("file")


def file_name_column() -> Column:
    return F.element_at(F.split(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/"), -1)


def csv_folder(
    spark: SparkSession, folder: str, null_text: str | Sequence[str] | None = NULL_TEXT,
    schemas: Mapping[str, T.StructType | str] | None = None, multi_line: bool = False, strict: bool = True,
) -> CsvFolder:
    """Every `*.csv` of a folder as a frame of its own, in order of name.

    A file that cannot be read is noted in `errors` and the others go on: an empty one and, if `strict`, one with
    lines that don't fit its header or its schema, or with line breaks inside quotes without `multi_line`. Two
    passes read all files: one for header lines and quotes, one for rows and misfits, in which files with one
    header are read together. The driver holds a row per file, as the mapping does.
    """
    loaded = CsvFolder(spark, folder, null_text=null_text, schemas=schemas, multi_line=multi_line, strict=strict)
    texts = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = texts.select(
        file_name_column().alias("file"), "value", quotes.alias("quotes"),
        F.struct(F.input_file_block_start(), F.monotonically_increasing_id()).alias("at"),
    )
    lines = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"), F.count_if(F.col("quotes") % 2 == 1).alias("open"))
    seen = {r["file"]: r for r in lines.collect()}
    columns: dict[str, list[str]] = {}  # by header line
    alike: dict[tuple, list[str]] = {}  # files that are read together
    for name in sorted(file_name(uri) for uri in texts.inputFiles()):
        line = seen[name]["line"] if name in seen else ""
        if not line:
            loaded.errors[name] = "no columns"
            continue
        if strict and not multi_line and seen[name]["open"]:
            loaded.errors[name] = f"{seen[name]['open']} lines open or close a quote of another line: multi_line reads them"
            continue
        try:
            if line not in columns:
                reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
                columns[line] = reader.csv(f"{folder}/{name}").columns
        except PySparkException as error:
            loaded.errors[name] = str(error)
            continue
        loaded.headers[name], loaded.rows[name] = columns[line], 0
        schema = (schemas or {}).get(name) if not isinstance(null_text, (list, tuple)) else None
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kinds = [f.dataType.simpleString() for f in wanted.fields] if wanted else ["string"] * len(columns[line])
        alike.setdefault(tuple(kinds), []).append(name)
    for kinds, names in alike.items():
        for r in fitting(spark, [f"{folder}/{name}" for name in names], kinds, null_text, multi_line).collect():
            loaded.rows[r["file"]] = r["rows"]
            if strict and r["bad"]:
                loaded.errors[r["file"]] = f"row {r['first']} doesn't fit the columns, {r['bad']} of {r['rows']} don't"
                del loaded.headers[r["file"]], loaded.rows[r["file"]]
    return loaded


def fitting(
    spark: SparkSession, paths: Sequence[str], kinds: Sequence[str], null_text: str | Sequence[str] | None, multi_line: bool,
) -> DataFrame:
    """Per file with rows: how many it has, how many don't fit columns of these types (`bad`) and the number of
    the `first` one of these. One read and partial counts by file and block; rows of a block are numbered
    without gaps."""
    schema = ", ".join([*(f"c{i} {kind}" for i, kind in enumerate(kinds)), "misfit string"])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("columnNameOfCorruptRecord", "misfit").option("columnPruning", False)
    if isinstance(null_text, str):
        reader = reader.option("nullValue", null_text)
    some = F.coalesce(F.length(F.col("c0").cast("string")), F.lit(0)) >= 0  # always: a misfit isn't read alone
    rows = reader.csv(list(paths)).select(
        file_name_column().alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), (F.col("misfit").isNotNull() & some).alias("bad"),
    )
    blocks = rows.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("bad"), F.min("n").alias("low"),
        F.min(F.when(F.col("bad"), F.col("n"))).alias("first"),
    )
    earlier = F.sum("rows").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.withColumn("first", F.coalesce(earlier, F.lit(0)) + F.col("first") - F.col("low") + 1)
    return placed.groupBy("file").agg(F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), F.min("first").alias("first"))


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def named_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """Table of the catalog."""
    return spark.table(f"`{schema}`.`{table}`")


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    partitions: int = 1,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A whole database table.

    One connection reads it unless it is split: by ranges of a numeric, date or timestamp column
    (its least and largest value are asked for first), or by `predicates`, one per task, which
    together must cover every row - the way to split a skewed or text key.
    """
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    if partition_column is None or partitions <= 1:
        return spark.read.jdbc(url, table, properties=options)
    ends = f"(SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}) ends"
    low, high = spark.read.jdbc(url, ends, properties=options).first()
    if low is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=str(low), upperBound=str(high),
        numPartitions=partitions, properties=options,
    )


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line: value."""
    return spark.read.text(path)


def file_listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """File name and length of the files of a folder, one row per file; their content is not read.

    The names come from the listing that Spark makes on the driver for every read; lengths are those
    of the files it would scan, which leaves out empty ones. Files of one name in several subfolders
    are several rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    found = [(file_name(uri), plain_path(unquote(uri))) for uri in files.inputFiles()]
    names = spark.createDataFrame(found, "file string, place string")
    place = F.regexp_replace("path", SCHEME, "")
    lengths = files.select(place.alias("place"), "length")
    return names.join(lengths, "place", "left").select("file", F.coalesce("length", F.lit(0)).alias("length"))


SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def plain_path(uri: str) -> str:
    return re.sub(SCHEME, "", uri)


def file_name(uri: str) -> str:
    return unquote(uri.rsplit("/", 1)[-1])


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Kind, name and size in KB of the files of a folder, by name."""
    return inventory(file_listing(spark, folder, pattern))


def inventory(files: DataFrame) -> DataFrame:
    return files.select(
        prefix_category(F.col("file"), FILE_KINDS, OTHER_FILE).alias("kind"),
        "file",
        F.round(kilobytes(F.col("length")), 1).alias("size_kb"),
    ).orderBy("file")


def expected_files(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """For a fixed list of files: whether each exists, and its size in KB and MB."""
    wanted = spark.createDataFrame([(n,) for n in names], "file string")
    return wanted.join(file_listing(spark, folder), "file", "left").select(
        "file",
        F.col("length").isNotNull().alias("exists"),
        F.round(kilobytes(F.col("length")), 1).alias("size_kb"),
        F.round(megabytes(F.col("length")), 2).alias("size_mb"),
    )


def query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], args: Mapping | None = None) -> DataFrame:
    """Ad hoc SQL over named frames; values go in as `:name` parameters, not into the text.

    Only queries run: anything that would change a table or a setting is refused by the parser. The
    names are views while the query is planned; views of the caller under these names come back.
    """
    before = {}
    for view in spark.catalog.listTables():
        if view.isTemporary and view.name in {name.lower() for name in tables} | set(tables):
            before[view.name] = spark.table(view.name)
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        return spark.sql(f"SELECT * FROM (\n{sql.rstrip().rstrip(';')}\n)", args=dict(args or {}))
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)
