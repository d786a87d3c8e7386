"""What the operators of this subpackage share: columns by name, saved tables, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.session import configure, new_folder

# Code points that part words: space and the controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"

# Arrow batches stay small where texts are long, and the shuffle files of a finished step go.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def position(df: DataFrame, name: str) -> int:
    """Place of a column: the exact name, else the first that differs only in case."""
    exact = [i for i, c in enumerate(df.columns) if c == name]
    loose = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not exact + loose:
        raise ValueError(f"no column {name!r} in {df.columns}")
    return (exact + loose)[0]


def numbered(df: DataFrame) -> DataFrame:
    """Columns under the names c0, c1, ..., so that no name of the input can clash with ours."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def picked(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under new names: picked(df, id="doc_id", text="text")."""
    plain = numbered(df)
    return plain.select(*[F.col(f"c{position(df, old)}").alias(new) for new, old in wanted.items()])


def carried(df: DataFrame, result: DataFrame, added: list[str]) -> DataFrame:
    """`result` holds c0, c1, ... of `df` and the added columns. Gives the input's names back; an
    input column that has the name of an added one, in any case, is replaced by it."""
    taken = {name.lower() for name in added}
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in taken]
    return result.select(*kept, *added)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written as a table in the shared folder and read again: computed once, lineage cut, and
    safe when executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_hash(text: Column, salt: str = "") -> Column:
    """Two independent 64-bit hashes as one struct."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second" + salt), text).alias("b"))


def words_of(text: Column) -> Column:
    """Words between spaces, tabs and line breaks; null has none."""
    plain = F.coalesce(text, F.lit(""))
    for space in SPACES[1:]:
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(plain, " ", -1), "")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of `edges` (columns a, b): rows (node, root).

    Alternates large and small stars: every node joins its larger neighbours to the smallest one it
    knows. Each step is written to the shared folder. A node with many neighbours is a partial
    minimum, then a join of two tables that adaptive execution can split; nothing is gathered. What the
    next round needs of a node also tells whether there is one: edges that are stars already are looked at once.
    """
    def stars(links: DataFrame) -> DataFrame:
        """Least neighbour of each node (or itself), how many are smaller, whether one is larger."""
        of = links.groupBy("a").agg(
            F.min("b").alias("low"), F.count_if(F.col("b") < F.col("a")).alias("up"), F.max(F.col("b") > F.col("a")).alias("down")
        )
        return saved(of.select("a", F.least("a", "low").alias("low"), "up", "down"), "stars")

    def ordered(links: DataFrame) -> DataFrame:
        return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    now = saved(ordered(edges).distinct(), "links")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        star = stars(both)
        # Done when every node has one neighbour below it at most and then none above it.
        if star.where("up > 1 OR up = 1 AND down").limit(1).count() == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        met = both.join(star.select("a", "low"), "a").where("b > a")
        # No more rows than edges; doubles go in the second half of the round.
        now = saved(ordered(met.select(F.col("b").alias("a"), F.col("low").alias("b"))), "links")
        met = now.join(stars(now).select("a", "low"), "a")
        both = met.select(F.col("b").alias("a"), F.col("low").alias("b")).union(met.select("a", F.col("low").alias("b")))
        now = saved(ordered(both).distinct(), "links")
