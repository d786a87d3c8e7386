"""Where tables go: Parquet, snapshots, the catalog and CSV. These run jobs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted
from quaylake.functions.time import utc_instant
from quaylake.session import file_system, moved, removed

SNAPSHOT_COLUMN = "snapshot_ts"

# Names that begin so are snapshots on their way out; readers pass over names with an underscore in front.
REMOVED = "_removed-"


def stamped(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Ingestion instant and date as ISO text, the same for all rows, in UTC."""
    instant = utc_instant(as_of)
    return df.withColumns(
        {
            "_ingestion_ts_utc": F.lit(instant.isoformat()),
            "_ingestion_date": F.lit(instant.date().isoformat()),
        }
    )


def overwrite_parquet(df: DataFrame, path: str) -> DataFrame:
    """Replace a Parquet table and return it as written; `df` may read from `path`.

    The new table is written beside the old one, which is put aside only when the job has succeeded.
    """
    put_in_place(df.sparkSession, written_beside(df, path), path)
    return df.sparkSession.read.parquet(path)


def written_beside(df: DataFrame, path: str, kind: str = "parquet", **options) -> str:
    """Writes to a sibling of `path`; after a failure nothing of it stays."""
    beside = f"{path.rstrip('/')}__new-{uuid.uuid4().hex}"
    try:
        df.write.format(kind).options(**(options or {"compression": "snappy"})).save(beside)
    except Exception:
        removed(df.sparkSession, beside)
        raise
    return beside


def put_in_place(spark: SparkSession, beside: str, path: str) -> None:
    """The old folder moves aside, the new one takes its place, then the old one goes. If the second
    move fails the old one comes back."""
    aside = f"{path.rstrip('/')}__old-{uuid.uuid4().hex}"
    had = moved(spark, path, aside)
    try:
        if not moved(spark, beside, path):
            raise FileNotFoundError(beside)
    except Exception:
        if had:
            moved(spark, aside, path)
        raise
    if had:
        removed(spark, aside)


def overwrite_if_any(df: DataFrame, path: str) -> bool:
    """Replace a Parquet table unless there are no rows; then the old table stays."""
    return overwrite_observed(df, path) is not None


def overwrite_observed(df: DataFrame, path: str, measures: Sequence[Column] = ()) -> dict | None:
    """Replace a Parquet table and return `measures` of it by name, or None without rows; then the old table stays.

    `df` is computed once. Its rows are counted and measured by the tasks that write them (`DataFrame.observe`),
    each task once however often it is tried, so nothing is read again.
    """
    spark, seen, rows = df.sparkSession, Observation(), f"rows_{uuid.uuid4().hex}"
    beside = written_beside(df.observe(seen, F.count(F.lit(1)).alias(rows), *measures), path)
    found = dict(seen.get)
    if not found.pop(rows):
        removed(spark, beside)
        return None
    put_in_place(spark, beside, path)
    return found


def overwrite_ordered(
    df: DataFrame, path: str, ranges: Sequence[str], equal: Sequence[str] = (), files: int | None = None
) -> DataFrame:
    """Replace a Parquet table by one whose files hold ranges of the columns `ranges` and are sorted by them.

    A filter on the first of these columns then skips files and row groups by their least and largest values. The
    columns `equal` get Bloom filters, by which a row group without a wanted value is skipped. Rows that are equal
    in `ranges` are dealt to several files where they are many. `files` is the number of files, by default that of
    the shuffle partitions, which adaptive execution may lessen.
    """
    tie = f"tie_{uuid.uuid4().hex}"
    keys = [quoted(c) for c in ranges]
    marked = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = marked.repartitionByRange(*([files] if files else []), *keys, quoted(tie))
    blooms = {f"parquet.bloom.filter.enabled#{c}": True for c in equal}
    options = {"compression": "snappy", "parquet.bloom.filter.adaptive.enabled": True, **blooms}
    beside = written_beside(dealt.sortWithinPartitions(*keys).drop(tie), path, **options)
    put_in_place(df.sparkSession, beside, path)
    return df.sparkSession.read.parquet(path)


def land(df: DataFrame, path: str, as_of: datetime | None = None) -> bool:
    """Bronze landing: stamp and replace, unless there are no rows."""
    return overwrite_if_any(stamped(df, as_of), path)


def write_snapshot(df: DataFrame, folder: str, as_of: datetime | None = None, keep: int | None = None) -> str | None:
    """Keep a frame as a new snapshot of `folder`/history and as `folder`/latest; with `keep` all but the newest
    `keep` snapshots are deleted then. Returns the label, or None when there are no rows."""
    written = observed_snapshot(df, folder, as_of, keep=keep)
    return written and written[0]


def observed_snapshot(
    df: DataFrame, folder: str, as_of: datetime | None = None, measures: Sequence[Column] = (), keep: int | None = None
) -> tuple[str, dict] | None:
    """As `write_snapshot`, with `measures` of the rows.

    The source is read once, also to see whether it has rows and to measure it: `latest` is copied from the
    snapshot just written, so both hold the same rows even when the source changes meanwhile or an executor
    is lost. An empty snapshot never becomes visible. Writing the same instant again replaces its snapshot.
    """
    label = utc_instant(as_of).strftime("%Y%m%d_%H%M%S")
    snapshot = f"{folder}/history/{SNAPSHOT_COLUMN}={label}"
    found = overwrite_observed(df, snapshot, measures)
    if found is None:
        return None
    overwrite_parquet(df.sparkSession.read.parquet(snapshot), f"{folder}/latest")
    if keep is not None:
        delete_old_snapshots(df.sparkSession, folder, keep)
    return label, found


def delete_old_snapshots(spark: SparkSession, folder: str, keep: int) -> list[str]:
    """Delete all but the newest `keep` snapshots of `folder`/history, by label; the labels that are gone.

    In two steps: all that go are first renamed to names that no reader takes, then deleted. A run that breaks off
    leaves whole snapshots in the history and renamed ones beside them, which the next run deletes. A reader of a
    snapshot that goes meanwhile fails. The driver lists one folder per snapshot.
    """
    if keep < 1:
        raise ValueError("at least one snapshot must stay")
    files, place = file_system(spark, f"{folder}/history")
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    labels = sorted(m[1] for n in names if (m := re.fullmatch(rf"{SNAPSHOT_COLUMN}=(\d{{8}}_\d{{6}})", n)))
    old, marked = labels[:-keep], [n for n in names if n.startswith(REMOVED)]
    for label in old:
        marked.append(f"{REMOVED}{label}-{uuid.uuid4().hex}")
        moved(spark, f"{folder}/history/{SNAPSHOT_COLUMN}={label}", f"{folder}/history/{marked[-1]}")
    for name in marked:
        removed(spark, f"{folder}/history/{name}")
    return old


def history(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshots, with their label as a partition column and the columns of all of them: one that
    a snapshot lacks is null there."""
    reader = spark.read.option("basePath", f"{folder}/history").option("mergeSchema", True)
    return reader.parquet(f"{folder}/history/{SNAPSHOT_COLUMN}=????????_??????")


def replace_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table with the rows of `df`; `path` keeps its files there. The old table
    stays until the new one is complete, also when the job fails, and `df` may read from it."""
    return swap_table(df, table, path)


def place_of(spark: SparkSession, table: str) -> str:
    """Where a catalog table keeps its files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """View of the session over a frame."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def store_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """View of the catalog, which outlives the session; `sql` may name tables and views of the catalog."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def swap_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Build a table under a temporary name, then put it in the place of the old one.

    Readers see the old table until the new one is complete; `df` may read from it. With a `path` every
    build has a new folder below it. The old table is renamed aside, put back if the new one can't take its
    name, and dropped last, together with the folder of its own build. After a failure the old rows are there.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    building, aside = f"{table}__new_{mark}", f"{table}__old_{mark}"
    files, place = file_system(spark, path) if path is not None else (None, None)
    builds = f"{files.makeQualified(place).toString().rstrip('/')}/build-" if path is not None else None
    had, renamed = spark.catalog.tableExists(table), False
    old = place_of(spark, table) if had else ""
    try:
        writer = df.write.format("parquet")
        (writer if path is None else writer.option("path", f"{builds}{mark}")).saveAsTable(building)
        if had:
            spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
            renamed = True
        spark.sql(f"ALTER TABLE {building} RENAME TO {table}")
    except Exception:
        if renamed:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {building}")
        if path is not None:
            removed(spark, f"{builds}{mark}")
        raise
    if had:
        spark.sql(f"DROP TABLE {aside}")
        if path is not None and old.startswith(builds):
            removed(spark, old)
    return spark.table(table)


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header, in the order of `df`. An old export stays until the new one is complete.

    With `one_file` the parts are written by as many tasks as `df` has and then joined in their order into one
    file with one header, by the file system itself where it can (HDFS), else by copying; no task and no frame
    on the driver holds all rows."""
    spark = df.sparkSession
    if not one_file:
        put_in_place(spark, written_beside(df, path, "csv", header=True, escape='"'), path)
        return
    parts = written_beside(df, path, "csv", header=False, escape='"')
    whole = None
    try:
        whole = written_beside(spark.createDataFrame([], df.schema).coalesce(1), path, "csv", header=True, escape='"')
        joined_files(spark, parts, whole)
        put_in_place(spark, whole, path)
    except Exception:
        if whole is not None:
            removed(spark, whole)
        raise
    finally:
        removed(spark, parts)


def joined_files(spark: SparkSession, parts: str, whole: str) -> None:
    """Puts the files of the folder `parts` behind the one file of the folder `whole`, in order of their names."""
    files, place = file_system(spark, parts)

    def data(folder) -> list:
        return sorted((f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")), key=str)

    target = data(spark._jvm.org.apache.hadoop.fs.Path(whole))[0]
    sources = [p for p in data(place) if files.getFileStatus(p).getLen()]
    if files.getUri().getScheme() == "hdfs" and files.getFileStatus(target).getLen():
        array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(sources))
        for i, source in enumerate(sources):
            array[i] = source
        files.concat(target, array)
        return
    done = target.suffix(".joined")
    out = files.create(done, True)
    try:
        for source in [target, *sources]:
            stream = files.open(source)
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            stream.close()
    finally:
        out.close()
    files.delete(target, False)
    if not files.rename(done, target):
        raise OSError(f"{done} could not be renamed to {target}")
