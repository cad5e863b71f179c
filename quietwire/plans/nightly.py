"""One run over any number of dates: from the stored tables to baselines, scores, digests, ledger and run log.

All dates of a run are worked out together. Dates without trading are logged and nothing else; dates
that the ledger holds were delivered before and are left alone, so a rerun changes nothing.

A message waits in the outbox until ``confirm`` says that it is out; only then does the ledger hold its date. So a
message that was lost on its way is offered again, word for word, by the next run or ``pending``. A failure
is logged for every open date, leaves an alert in the outbox, and is raised again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietwire import schema
from quietwire.operators.baselines import baselines, history_since
from quietwire.operators.market_calendar import is_trading_day
from quietwire.plans import funnel, report
from quietwire.session import stage
from quietwire.settings import DEFAULT_WATCHLIST, HOLIDAYS, LOOKBACK_DAYS, Thresholds
from quietwire.sources.landed import lookback
from quietwire.sources.tables import create_table, read_table, replace_table, upsert, upsert_partitions
from quietwire.streaming.arrivals import NEWS, PRICES


def _with(table: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*table.fields, T.StructField(name, kind)])


BASELINES = _with(schema.BASELINES, "year", T.IntegerType())
SCORES = schema.ITEM_SCORES
LEDGER = _with(schema.SENT_DIGESTS, "year", T.IntegerType())
LOG = _with(schema.RUN_LOG, "year", T.IntegerType())
OUTBOX = _with(schema.OUTBOX, "year", T.IntegerType())
DIGEST, ALERT = "digest", "alert"


@dataclass(frozen=True)
class Store:
    """The folder that holds all tables of an installation."""

    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def create(self, spark: SparkSession, watchlist: Iterable[str] = DEFAULT_WATCHLIST) -> None:
        """Empty tables, and the symbols an installation starts with. Symbols that are there stay as they are."""
        for name, kind, partition in (
            ("daily_close", PRICES, "year"),
            ("news_items", NEWS, "published_date"),
            ("baselines", BASELINES, "year"),
            ("item_scores", SCORES, "run_date"),
            ("sent_digests", LEDGER, "year"),
            ("run_log", LOG, "year"),
            ("outbox", OUTBOX, "year"),
        ):
            create_table(spark, self.path(name), kind, partition)
        self.seed(spark, watchlist)

    def seed(self, spark: SparkSession, symbols: Iterable[str]) -> None:
        path = self.path("watchlist")
        rows = spark.createDataFrame([(s, None) for s in symbols], schema.WATCHLIST)
        create_table(spark, path, schema.WATCHLIST)
        replace_table(spark, path, upsert(read_table(spark, path, schema.WATCHLIST), rows, ["symbol"], insert_only=True))

    def read(self, spark: SparkSession, table: str, kind: T.StructType) -> DataFrame:
        return read_table(spark, self.path(table), kind)


def take_in_again(store: Store, landed: DataFrame, run_date: date, days: int = LOOKBACK_DAYS) -> int:
    """Upserts the landed price rows of the run date and the days before it, so that a lost day heals."""
    spark = landed.sparkSession
    rows = lookback(landed, run_date, days=days).withColumn("year", F.year("trade_date"))
    rows = rows.withColumn("fetched_at", F.current_timestamp()).select(*PRICES.names)
    return upsert_partitions(spark, store.path("daily_close"), PRICES, rows, ["symbol", "trade_date"], "year", follows=True)


def heal(store: Store, landed: DataFrame, first: date, last: date, days: int = LOOKBACK_DAYS) -> list[date]:
    """Takes in the landed price rows from ``days`` before ``first`` up to ``last`` that the store lacks; returns
    their dates. Both sides are read for these days only, and a store without gaps is not written."""
    spark, keys = landed.sparkSession, ["symbol", "trade_date"]
    within = F.col("trade_date").between(F.lit(first - timedelta(days=days)), F.lit(last))
    stored = store.read(spark, "daily_close", PRICES).where(within & F.col("year").between((first - timedelta(days=days)).year, last.year))
    lost = stage(landed.where(within).join(stored.select(*keys), keys, "left_anti"), "lost")
    found = sorted(r[0] for r in lost.select("trade_date").distinct().collect())
    if found:
        rows = lost.withColumn("year", F.year("trade_date")).withColumn("fetched_at", F.current_timestamp()).select(*PRICES.names)
        upsert_partitions(spark, store.path("daily_close"), PRICES, rows, keys, "year", follows=True)
    return found


def write_baselines(store: Store, prices: DataFrame, since: date, window: int) -> int:
    """Works the baselines out again from ``since`` on. Only the years from then on are read and rewritten."""
    rows = baselines(history_since(prices, since, window), window).where(F.col("trade_date") >= F.lit(since))
    rows = rows.withColumn("year", F.year("trade_date")).select(*BASELINES.names)
    return upsert_partitions(prices.sparkSession, store.path("baselines"), BASELINES, rows, ["symbol", "trade_date"], "year", follows=True)


def _write(store: Store, table: str, kind: T.StructType, rows: DataFrame, keys: list[str]) -> int:
    rows = rows.withColumn("year", F.year("run_date")).select(*kind.names)
    return upsert_partitions(rows.sparkSession, store.path(table), kind, rows, keys, "year", follows=True)


def run(
    spark: SparkSession,
    store: Store,
    dates: Iterable[date],
    trigger: str | None = None,
    limits: Thresholds = Thresholds(),
    holidays: Iterable[str] = HOLIDAYS,
    landed: DataFrame | None = None,
) -> DataFrame:
    """Digests the given dates; returns (run_date, message) of those to be delivered now. A date whose digest
    waits in the outbox is not worked out again. Given the ``landed`` price rows, days that were lost are
    taken in first, and baselines are worked out again from the first of them on."""
    asked = spark.createDataFrame([(d,) for d in sorted(set(dates))], "run_date date")
    started = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    ledger = store.read(spark, "sent_digests", LEDGER)
    trading = asked.where(is_trading_day(F.col("run_date"), holidays))
    unsent = report.unsent(trading, ledger)
    waiting = pending(spark, store, DIGEST).join(unsent, "run_date", "left_semi").select("run_date", "message")
    waiting = stage(waiting, "waiting")
    open_dates = [r["run_date"] for r in report.unsent(unsent, waiting).orderBy("run_date").collect()]
    closed = asked.where(~is_trading_day(F.col("run_date"), holidays))
    _write(store, "run_log", LOG, _logged(closed, holidays, started, trigger), ["run_date", "trigger"])
    if not open_dates:
        return waiting
    try:
        healed = [] if landed is None else heal(store, landed, open_dates[0], open_dates[-1])
        since = min([open_dates[0], *healed])
        return waiting.unionByName(_digested(spark, store, open_dates, since, started, trigger, limits, holidays))
    except Exception as error:
        failures = spark.createDataFrame([(d, str(error)) for d in open_dates], "run_date date, error string")
        failed = stage(report.failed_run(failures, F.current_timestamp(), trigger), "failed")
        _write(store, "run_log", LOG, failed, ["run_date", "trigger"])
        _post(store, ALERT, report.failure_alerts(failed).select("run_date", F.col("alert").alias("message")))
        raise


def _post(store: Store, kind: str, messages: DataFrame) -> None:
    """Puts (run_date, message and perhaps item_count) into the outbox."""
    count = F.col("item_count") if "item_count" in messages.columns else F.lit(0)
    rows = messages.select(
        "run_date", F.lit(kind).alias("kind"), "message", count.cast("int").alias("item_count"),
        F.current_timestamp().alias("created_at"), F.lit(None).cast("timestamp").alias("delivered_at"),
    )
    _write(store, "outbox", OUTBOX, rows, ["run_date", "kind"])


def pending(spark: SparkSession, store: Store, kind: str | None = None) -> DataFrame:
    """(run_date, kind, message, item_count) of all that is not known to be out."""
    box = store.read(spark, "outbox", OUTBOX).where("delivered_at is null")
    sent = store.read(spark, "sent_digests", LEDGER).select("run_date", F.lit(DIGEST).alias("kind"))
    rows = box if kind is None else box.where(F.col("kind") == kind)
    return rows.join(sent, ["run_date", "kind"], "left_anti").select("run_date", "kind", "message", "item_count")


def confirm(spark: SparkSession, store: Store, delivered: Iterable[date], kind: str = DIGEST) -> int:
    """Marks messages as out: digests in the ledger first, which alone decides, then in the outbox. Confirming
    twice, or what never waited, changes nothing. Returns the number of messages."""
    days = spark.createDataFrame([(d,) for d in sorted(set(delivered))], "run_date date")
    now = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    out = stage(pending(spark, store, kind).join(days, "run_date", "left_semi"), "delivered")
    if kind == DIGEST:
        counts = out.withColumnRenamed("item_count", "sent")
        _write(store, "sent_digests", LEDGER, report.mark_sent(counts, F.lit(now)), ["run_date"])
    # A crash may have left a date in the ledger alone.
    box = store.read(spark, "outbox", OUTBOX).where((F.col("kind") == kind) & F.col("delivered_at").isNull())
    _write(store, "outbox", OUTBOX, box.join(days, "run_date", "left_semi").withColumn("delivered_at", F.lit(now)), ["run_date", "kind"])
    return out.count()


def deliver(spark: SparkSession, store: Store, send: Callable[[date, str, str], None]) -> list[tuple[date, str]]:
    """Hands every waiting message, oldest first, to ``send(run_date, kind, message)`` and confirms it once
    that returns. The first error ends it; what was sent until then is confirmed, the rest waits. One message
    a date and kind, so they fit the driver."""
    done: list[tuple[date, str]] = []
    try:
        for row in pending(spark, store).orderBy("run_date", "kind").collect():
            send(row["run_date"], row["kind"], row["message"])
            done.append((row["run_date"], row["kind"]))
    finally:
        for kind in sorted({kind for _, kind in done}):
            confirm(spark, store, [d for d, k in done if k == kind], kind)
    return done


def _logged(counts: DataFrame, holidays: Iterable[str], started, trigger: str | None) -> DataFrame:
    missing = {s: F.lit(None).cast("int") for s in schema.STAGES if s not in counts.columns}
    trading = is_trading_day(F.col("run_date"), holidays)
    return report.run_log(counts.withColumns(missing) if missing else counts, trading, F.lit(started), F.current_timestamp(), trigger)


def _digested(spark, store, open_dates, since, started, trigger, limits, holidays) -> DataFrame:
    first, last = open_dates[0], open_dates[-1]
    prices = store.read(spark, "daily_close", PRICES).where(F.col("trade_date") <= F.lit(last))
    write_baselines(store, prices, since, limits.window)
    # Dates bound the partitions that are read; a news item is stored under the date it first had.
    news = store.read(spark, "news_items", NEWS).where(F.to_date("published_at").isin(open_dates))
    watched = store.read(spark, "watchlist", schema.WATCHLIST).select("symbol")
    recent = history_since(prices, first, limits.window)
    stages = funnel.item_stages(news, recent, watched, limits, holidays)
    days = spark.createDataFrame([(d,) for d in open_dates], "run_date date")
    counts = days.join(funnel.stage_counts(stages), "run_date", "left").fillna(0, list(schema.STAGES))
    counts = stage(counts, "stage-counts")
    digest = stage(funnel.digest_of(stages, news), "digests")
    scores = funnel.item_scores(stages).select(*SCORES.names)
    upsert_partitions(spark, store.path("item_scores"), SCORES, scores, ["item_id", "run_date"], "run_date", follows=True)
    report.write_documents(report.digest_documents(digest, counts, trigger), store.path("digests"))
    messages = stage(report.digest_messages(digest, counts), "messages")
    _post(store, DIGEST, messages.join(counts.select("run_date", F.col("sent").alias("item_count")), "run_date"))
    _write(store, "run_log", LOG, _logged(counts, holidays, started, trigger), ["run_date", "trigger"])
    return messages
