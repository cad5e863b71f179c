"""How good the funnel is, measured on history."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.operators.baselines import baselines, next_day_label
from quietwire.operators.surprise import is_surprising
from quietwire.settings import Thresholds

MATERIAL = 3.0
IMMATERIAL = 0.2


def labelled_days(prices: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """(symbol, run_date, next_move, material, immaterial); the flags are null without a next move."""
    move = F.abs("next_move")
    return (
        next_day_label(baselines(prices, limits.window))
        .withColumn("material", move >= MATERIAL)
        .withColumn("immaterial", move <= IMMATERIAL)
        .select("symbol", F.col("trade_date").alias("run_date"), "next_move", "material", "immaterial")
    )


def miss_rate(stages: DataFrame) -> DataFrame:
    """Of the suppressed items with a known next move, the share before a material one.

    The move to the next day came along with the scores, so no price is read again.
    """
    labelled = stages.where("NOT sent AND next_move IS NOT NULL")
    counts = labelled.agg(F.count(F.lit(1)).alias("suppressed"), F.count_if(F.abs("next_move") >= MATERIAL).alias("missed"))
    return counts.withColumn("miss_rate", F.try_divide(F.col("missed").cast("double"), F.col("suppressed").cast("double")))


def threshold_sweep(
    stages: DataFrame,
    volume_thresholds: Iterable[float],
    return_thresholds: Iterable[float],
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Average digest size and misses for every pair of thresholds.

    All items of one (run_date, symbol) share their scores, so kept items are first counted per
    cell. Only these few rows are repeated per grid point; items are not.
    """
    grid = F.array(
        *(
            F.struct(F.lit(float(v)).alias("vol_t"), F.lit(float(r)).alias("ret_t"))
            for v in volume_thresholds
            for r in return_thresholds
        )
    )
    cells = stages.groupBy("run_date", "symbol").agg(
        F.count_if("deduped").alias("kept"),
        F.max("volume_z").alias("volume_z"),
        F.max("return_z").alias("return_z"),
        F.max("watched").alias("watched"),
        (F.abs(F.max("next_move")) >= MATERIAL).alias("material"),
    )
    passes = is_surprising(F.col("vol_t"), F.col("ret_t")) & F.col("watched")
    per_day = (
        cells.select("*", F.inline(grid))
        .withColumn("passing", F.when(passes, F.col("kept")).otherwise(0))
        .groupBy("vol_t", "ret_t", "run_date")
        .agg(
            F.sum("passing").alias("passing"),
            F.sum(F.when(F.col("material") & ~passes, F.col("kept")).otherwise(0)).alias("missed"),
        )
    )
    size = F.least(F.col("passing"), F.lit(limits.digest_size))
    return per_day.groupBy("vol_t", "ret_t").agg(F.avg(size).alias("avg_digest_size"), F.sum("missed").alias("misses"))
