"""Membership in the watchlist, whatever the case of the symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.operators.skew import lookup_join
from quietwire.session import stage


def mark_watched(rows: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Adds ``watched``. An empty watchlist watches everything.

    The list is staged, so its size is known: a short one is sent to the rows, which stay where they
    are; a long one is joined with busy symbols and those without one spread.
    """
    listed = watchlist.where("symbol IS NOT NULL").select(F.upper("symbol").alias("_listed")).distinct()
    listed = stage(listed.withColumn("watched", F.lit(True)), "watchlist")
    if watchlist.isEmpty():
        return rows.withColumn("watched", F.lit(True))
    marked = lookup_join(rows.withColumn("_listed", F.upper("symbol")), listed, ["_listed"], F.xxhash64(*rows.columns), "left")
    return marked.drop("_listed").withColumn("watched", F.coalesce("watched", F.lit(False)))
