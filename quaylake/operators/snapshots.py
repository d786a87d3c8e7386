"""Retention over a table of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted

# Fixed value: snapshots kept in the history.
MAX_SNAPSHOTS = 5


def newest_snapshots(
    history: DataFrame, snapshot: str = "snapshot_ts", keep: int = MAX_SNAPSHOTS
) -> DataFrame:
    """Rows of the newest `keep` snapshots.

    The oldest snapshot to keep is one scalar, so nothing is joined, and where the history is
    partitioned by the snapshot the older folders are not read.
    """
    newest = history.select(quoted(snapshot).alias("s")).distinct().orderBy(F.desc("s")).limit(keep)
    oldest_kept = newest.agg(F.min("s")).scalar()
    return history.filter(quoted(snapshot) >= oldest_kept)
