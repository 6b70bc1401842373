"""Snapshot selection and keep-latest."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_snapshot(raw: DataFrame, as_of: dt.date | None = None, day: dt.date | None = None) -> DataFrame:
    """Rows of the newest ``snapshot_date``, exposed as ``as_of_date``.

    ``as_of`` rebuilds a past day: later snapshots are ignored. The day comes from a scalar
    subquery, so on a day-partitioned table it prunes partitions at run time. Whoever knows the newest day
    already, from the store's folder names, gives it as ``day``, and nothing is searched.
    """
    if day is not None:
        return raw.where(F.col("snapshot_date") == F.lit(day)).withColumnRenamed("snapshot_date", "as_of_date")
    if as_of is not None:
        raw = raw.where(F.col("snapshot_date") <= F.lit(as_of))
    newest = raw.agg(F.max("snapshot_date")).scalar()
    return raw.where(F.col("snapshot_date") == newest).withColumnRenamed("snapshot_date", "as_of_date")


def keep_latest(rows: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    The remaining columns break ties, so the kept row does not depend on task order. It also means
    that several readers of the result shuffle the same columns and share one exchange. Each map
    task keeps one row per key before the shuffle, so a hot key does not reach one task whole.
    """
    ties = [c for c in rows.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*newest_first, *ties)
    return rows.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
