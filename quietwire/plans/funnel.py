"""raw -> deduped -> surprising -> watchlist -> sent, for all run dates in one job.

Scores depend on (symbol, day) only and the watchlist on the symbol only, so both are settled
on the small table of cells (one row per symbol and trading day) and meet the items in one join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietwire.functions.text import article_text
from quietwire.operators.baselines import baselines, next_day_label
from quietwire.operators.market_calendar import is_trading_day
from quietwire.operators.near_duplicates import near_duplicates
from quietwire.operators.skew import lookup_join, number_rows
from quietwire.operators.surprise import is_surprising, reason, score, strength
from quietwire.operators.watchlist import mark_watched
from quietwire.schema import STAGES
from quietwire.session import stage
from quietwire.settings import HOLIDAYS, Thresholds

_SCORES = ["volume_z", "return_z"]


def scored_cells(prices: DataFrame, watchlist: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Staged: symbol, run_date, volume_z, return_z, next_move, surprising, watched."""
    scored = score(next_day_label(baselines(prices, limits.window)), limits.min_obs).withColumn(
        "surprising", is_surprising(limits.volume_z, limits.return_z)
    )
    cells = mark_watched(scored.withColumnRenamed("trade_date", "run_date"), watchlist)
    return stage(cells.select("symbol", "run_date", *_SCORES, "next_move", "surprising", "watched"), "cells")


def daily_news(news: DataFrame, holidays: Iterable[str] | None = HOLIDAYS) -> DataFrame:
    """News under the day it was published. Other than trading days have no run (None: keep all)."""
    dated = news.withColumn("run_date", F.to_date("published_at"))
    return dated if holidays is None else dated.where(is_trading_day(F.col("run_date"), holidays))


def left_out(news: DataFrame, holidays: Iterable[str] = HOLIDAYS) -> DataFrame:
    """(run_date, items) of days without a run, so that what the funnel never sees is counted."""
    dated = daily_news(news, None)
    return dated.where(~is_trading_day(F.col("run_date"), holidays)).groupBy("run_date").agg(F.count(F.lit(1)).alias("items"))


def score_news(items: DataFrame, cells: DataFrame) -> DataFrame:
    """Left join on (symbol, run_date): items without a priced day have no scores."""
    scored = lookup_join(items, cells, ["symbol", "run_date"], F.col("id"), "left")
    return scored.withColumn("surprising", F.coalesce("surprising", F.lit(False))).withColumn(
        "watched", F.coalesce("watched", F.lit(False))
    )


def with_bucket(items: DataFrame) -> DataFrame:
    """Items are duplicates only within one symbol; those without a symbol share a bucket."""
    return items.withColumn("bucket", F.upper(F.coalesce("symbol", F.lit(""))))


def dedup_news(items: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    return near_duplicates(
        items,
        bucket=["run_date", "bucket"],
        order=["published_at"],
        text=article_text(F.col("title"), F.col("body")),
        threshold=limits.similarity,
    )


def _top(items: DataFrame, limits: Thresholds) -> DataFrame:
    # Every task keeps its own best rows before the shuffle, so a busy day is no hot spot.
    best_first = Window.partitionBy("run_date").orderBy(strength().desc(), "published_at", "id")
    return items.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= limits.digest_size)


def item_stages(
    news: DataFrame,
    prices: DataFrame,
    watchlist: DataFrame,
    limits: Thresholds = Thresholds(),
    holidays: Iterable[str] | None = HOLIDAYS,
) -> DataFrame:
    """Staged, one thin row per item: how far it got. Feeds counts, item scores and evaluation."""
    items = with_bucket(daily_news(news, holidays))
    groups = dedup_news(items, limits).select("id", "leader_id")
    thin = items.select("id", "run_date", "symbol", "bucket", "published_at").join(groups, "id")
    scored = score_news(thin, scored_cells(prices, watchlist, limits))
    deduped = F.col("id") == F.col("leader_id")
    flagged = stage(
        scored.withColumn("deduped", deduped)
        .withColumn("surprising", F.col("deduped") & F.col("surprising"))
        .withColumn("watchlist", F.col("surprising") & F.col("watched")),
        "flagged",
    )
    top = stage(_top(flagged.where("watchlist"), limits).select("id", "rank"), "top")
    ranked = lookup_join(flagged, top, ["id"], F.col("run_date"), "left").withColumn("sent", F.col("rank").isNotNull())
    passed = F.lit("raw")
    for name in STAGES[1:]:
        passed = F.when(F.col(name), name).otherwise(passed)
    return stage(ranked.withColumn("passed_stage", passed), "item-stages")


def stage_counts(stages: DataFrame) -> DataFrame:
    return stages.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("raw"), *(F.count_if(F.col(name)).alias(name) for name in STAGES[1:])
    )


def digest(
    news: DataFrame,
    prices: DataFrame,
    watchlist: DataFrame,
    limits: Thresholds = Thresholds(),
    holidays: Iterable[str] | None = HOLIDAYS,
) -> DataFrame:
    """Ranked digest items per run date.

    Same items as the full funnel, but buckets in which nothing can pass are dropped before
    any text is read: whole buckets pass or fail, so the filters commute with deduplication.
    """
    cells = scored_cells(prices, watchlist, limits).where("surprising AND watched").drop("next_move", "surprising", "watched")
    cells = stage(cells, "passing-cells")
    buckets = stage(with_bucket(cells).select("run_date", "bucket").distinct(), "passing-buckets")
    # What is left is small and used three times: texts are read once.
    columns = ["id", "symbol", "run_date", "bucket", "published_at", "title", "body", "url"]
    items = with_bucket(daily_news(news, holidays)).select(*columns)
    items = stage(lookup_join(items, buckets, ["run_date", "bucket"], F.col("id")), "passing-items")
    leaders = dedup_news(items, limits).where("id = leader_id").select("id")
    kept = lookup_join(
        items.select("id", "run_date", "symbol", "published_at", "title", "url").join(leaders, "id", "left_semi"),
        cells,
        ["symbol", "run_date"],
        F.col("id"),
    )
    return _top(kept, limits).select(
        "run_date", "rank", "id", "symbol", F.col("title").alias("headline"), "url", *_SCORES, reason().alias("reason")
    )


def digest_of(stages: DataFrame, news: DataFrame) -> DataFrame:
    """The digest of item stages that were worked out anyway. Only the sent items meet the texts."""
    sent = stage(stages.where("sent").select("id", "run_date", "symbol", "rank", *_SCORES), "sent")
    return lookup_join(news.select("id", "title", "url"), sent, ["id"], F.col("id")).select(
        "run_date", "rank", "id", "symbol", F.col("title").alias("headline"), "url", *_SCORES, reason().alias("reason")
    )


def item_scores(stages: DataFrame) -> DataFrame:
    """The item_scores table. Clusters are numbered from 0 within a run date."""
    leaders = stages.where("deduped").select("run_date", "bucket", "published_at", F.col("id").alias("leader_id"))
    numbered = number_rows(leaders, ["run_date"], ["bucket", "published_at", "leader_id"], "number")
    numbered = stage(
        numbered.select("leader_id", (F.col("number") - 1).cast("int").alias("dedup_group")), "cluster-numbers"
    )
    return lookup_join(stages, numbered, ["leader_id"], F.col("id")).select(
        F.col("id").alias("item_id"), "run_date", "dedup_group", *_SCORES, "passed_stage"
    )


def compression(sent: Column, raw: Column) -> Column:
    return F.coalesce(1 - F.try_divide(sent.cast("double"), raw.cast("double")), F.lit(0.0))
