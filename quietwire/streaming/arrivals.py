"""Nightly intake: whatever landed since the last run, once, in one triggered stream.

The stream only keeps track of which files were taken in. Late records need no watermark:
they are upserted under their key like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietwire.schema import DAILY_CLOSE, NEWS_ITEMS
from quietwire.sources.landed import arrival, news_rows, price_rows
from quietwire.sources.tables import upsert_partitions

PRICES = T.StructType([*DAILY_CLOSE.fields, T.StructField("year", T.IntegerType())])
# A backlog is taken in in batches of this size.
BATCH_BYTES = 256 << 30
NEWS = T.StructType([*NEWS_ITEMS.fields, T.StructField("published_date", T.DateType())])


def _take_in(spark: SparkSession, landing: str, checkpoint: str, write: Callable[[DataFrame], object]) -> None:
    files = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("maxBytesPerTrigger", str(BATCH_BYTES))
        .load(landing)
        .select(F.col("value").alias("payload"), arrival())
    )
    query = (
        files.writeStream.foreachBatch(lambda batch, _: write(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def take_in_prices(spark: SparkSession, landing: str, table: str, checkpoint: str) -> None:
    """New price payloads into daily_close, partitioned by year."""

    def write(batch: DataFrame) -> None:
        rows = price_rows(batch).rows.withColumn("fetched_at", F.current_timestamp())
        rows = rows.withColumn("year", F.year("trade_date"))
        upsert_partitions(batch.sparkSession, table, PRICES, rows, ["symbol", "trade_date"], "year", follows=True)

    _take_in(spark, landing, checkpoint, write)


def take_in_news(
    spark: SparkSession, landing: str, table: str, checkpoint: str, watchlist: DataFrame, insert_only: bool = False
) -> None:
    """New news payloads into news_items. An item stays under the date it was first published with."""

    def write(batch: DataFrame) -> None:
        rows = news_rows(batch, watchlist).rows.withColumn("fetched_at", F.current_timestamp())
        rows = rows.withColumn("published_date", F.to_date("published_at"))
        upsert_partitions(batch.sparkSession, table, NEWS, rows, ["id"], "published_date", insert_only)

    _take_in(spark, landing, checkpoint, write)
