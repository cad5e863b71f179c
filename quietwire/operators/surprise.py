"""Scores against the baseline, and the words for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.functions.values import filled, signed
from quietwire.settings import MIN_BASELINE_OBS, RETURN_Z, VOLUME_Z


def zscore(value: Column, mean: Column, spread: Column) -> Column:
    """Null when a part is missing or the spread is zero."""
    return (value.cast("double") - mean) / F.nullif(spread.cast("double"), F.lit(0.0))


def score(items: DataFrame, min_obs: int = MIN_BASELINE_OBS) -> DataFrame:
    """Adds volume_z and return_z; both null on a thin baseline."""
    deep = F.col("n_obs") >= min_obs
    return items.withColumn(
        "volume_z", F.when(deep, zscore(F.col("volume"), F.col("vol_mean_30d"), F.col("vol_std_30d")))
    ).withColumn("return_z", F.when(deep, zscore(F.col("daily_return"), F.col("ret_mean_30d"), F.col("ret_std_30d"))))


def _reaches(z: str, threshold: Column | float) -> Column:
    return F.coalesce(F.abs(z) >= threshold, F.lit(False))


def is_surprising(volume_t: Column | float = VOLUME_Z, return_t: Column | float = RETURN_Z) -> Column:
    return _reaches("volume_z", volume_t) | _reaches("return_z", return_t)


def strength() -> Column:
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(F.abs("volume_z"), zero), F.coalesce(F.abs("return_z"), zero))


def reason() -> Column:
    """Always in terms of the default thresholds, whatever the funnel ran with."""
    parts = F.concat_ws(
        ", ",
        F.when(_reaches("volume_z", VOLUME_Z), F.concat(F.lit("volume "), signed(F.col("volume_z")), F.lit("s"))),
        F.when(_reaches("return_z", RETURN_Z), F.concat(F.lit("price "), signed(F.col("return_z")), F.lit("s"))),
    )
    return F.coalesce(filled(parts), F.lit("watchlist"))
