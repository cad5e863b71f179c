"""Daily returns and rolling baselines per symbol.

The frame ends at the row before the current one: a day inside its own baseline could hardly
look unusual. A symbol has one row per trading day, so a window partition is bounded by the
calendar however many rows the table holds.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietwire.settings import BASELINE_WINDOW

def _by_day():
    return Window.partitionBy("symbol").orderBy("trade_date")


def _spread(column: str, frame) -> Column:
    # A constant series has spread zero exactly, whatever rounding says.
    flat = F.min(column).over(frame) == F.max(column).over(frame)
    spread = F.stddev_samp(column).over(frame)
    return F.when(flat & spread.isNotNull(), F.lit(0.0)).otherwise(spread)


def baselines(prices: DataFrame, window: int = BASELINE_WINDOW) -> DataFrame:
    """daily_close plus daily_return, the four moments and n_obs. One exchange and one sort."""
    frame = _by_day().rowsBetween(-window, -1)
    close = F.col("close").cast("double")
    return (
        prices.withColumn("daily_return", close / F.nullif(F.lag(close).over(_by_day()), F.lit(0.0)) - 1)
        .withColumn("vol_mean_30d", F.avg("volume").over(frame))
        .withColumn("vol_std_30d", _spread("volume", frame))
        .withColumn("ret_mean_30d", F.avg("daily_return").over(frame))
        .withColumn("ret_std_30d", _spread("daily_return", frame))
        .withColumn("n_obs", F.count("daily_return").over(frame))
    )


def history_since(prices: DataFrame, since: date, window: int = BASELINE_WINDOW) -> DataFrame:
    """The rows from ``since`` on and the history their baselines need.

    That is ``window`` rows per symbol for the frame and one more for the oldest return. The
    row-number filter lets each task drop all but the newest rows before the shuffle.
    """
    newest_first = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    earlier = (
        prices.where(F.col("trade_date") < F.lit(since))
        .withColumn("_age", F.row_number().over(newest_first))
        .where(F.col("_age") <= window + 1)
        .drop("_age")
    )
    return earlier.unionByName(prices.where(F.col("trade_date") >= F.lit(since)))


def baselines_since(prices: DataFrame, since: date, window: int = BASELINE_WINDOW) -> DataFrame:
    """Same rows as ``baselines`` from ``since`` on, from just the history those rows need."""
    return baselines(history_since(prices, since, window), window).where(F.col("trade_date") >= F.lit(since))


def next_day_label(priced: DataFrame) -> DataFrame:
    """The move from each day to the next, in units of that day's baseline spread."""
    following = F.lead("daily_return", 1).over(_by_day())
    return priced.withColumn("next_move", following / F.nullif(F.col("ret_std_30d"), F.lit(0.0)))
