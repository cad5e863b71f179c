"""Which (symbol, window) pairs of a history load still have to be fetched."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.settings import BACKFILL_COVERAGE, BACKFILL_WINDOW_DAYS


def backfill_windows(symbols: DataFrame, start: date, end: date, size: int = BACKFILL_WINDOW_DAYS) -> DataFrame:
    """(symbol, window_no, w_start, w_end). A window that would start on ``end`` is left out."""
    if start >= end:
        return symbols.select("symbol").where(F.lit(False)).selectExpr(
            "symbol", "0 window_no", "current_date() w_start", "current_date() w_end"
        )
    starts = F.sequence(F.lit(start), F.date_sub(F.lit(end), F.lit(1)), F.make_dt_interval(F.lit(size)))
    return (
        symbols.select("symbol")
        .distinct()
        .select("symbol", F.posexplode(starts).alias("window_no", "w_start"))
        .withColumn("w_end", F.least(F.date_add("w_start", size - 1), F.lit(end)))
    )


def backfill_gaps(
    symbols: DataFrame,
    prices: DataFrame,
    start: date,
    end: date,
    size: int = BACKFILL_WINDOW_DAYS,
    enough: float = BACKFILL_COVERAGE,
) -> DataFrame:
    """Windows of equal size make the window number arithmetic: an equi-join, not a range join."""
    stored = (
        prices.where(F.col("trade_date").between(F.lit(start), F.lit(end)))
        .select("symbol", "trade_date")
        .distinct()
        .groupBy("symbol", F.floor(F.datediff("trade_date", F.lit(start)) / size).cast("int").alias("window_no"))
        .agg(F.count(F.lit(1)).alias("covered"))
    )
    span = F.datediff("w_end", "w_start") + 1
    return (
        backfill_windows(symbols, start, end, size)
        .join(stored, ["symbol", "window_no"], "left")
        .withColumn("covered", F.coalesce("covered", F.lit(0)))
        .withColumn("span", span)
        .withColumn("needs_fetch", F.col("covered") < F.col("span") * enough)
        .drop("window_no")
    )
