"""What a run leaves behind: digest document, message, page aggregates, run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.functions.text import escape_html, truncate
from quietwire.functions.values import counted, filled, percent
from quietwire.plans.funnel import compression
from quietwire.schema import STAGES
from quietwire.settings import MARKET_ZONE

# Wording of the message and of the page.
DISCLAIMER = "<i>Information only, not investment advice.</i>"
MESSAGE_TITLE = "IDX digest"
NO_SYMBOL = "—"
STAGE_LABELS = {
    "raw": "Raw intake",
    "deduped": "Deduplicated",
    "surprising": "Above threshold",
    "watchlist": "On watchlist",
    "sent": "Sent",
}


def _per_run(digest: DataFrame, entry: Column, name: str) -> DataFrame:
    """One ordered array per run date. A digest is capped, so is the array."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", entry.alias("entry"))))
    return digest.groupBy("run_date").agg(F.transform(ordered, lambda e: e["entry"]).alias(name))


def digest_documents(digest: DataFrame, counts: DataFrame, trigger: str | None = None) -> DataFrame:
    """(run_date, payload): the JSON document per run date. A z of exactly 0 is written as null."""

    def shown(z: str) -> Column:
        return F.when(F.col(z) != 0, F.round(z, 2)).alias(z)

    entry = F.struct("symbol", "headline", "url", shown("volume_z"), shown("return_z"), "reason")
    items = _per_run(digest, entry, "items")
    empty = F.array().cast(items.schema["items"].dataType)
    document = F.struct(
        F.col("run_date").cast("string").alias("run_date"),
        F.lit("success").alias("status"),
        F.lit(trigger).alias("trigger"),
        F.struct(*STAGES).alias("stages"),
        F.coalesce("items", empty).alias("items"),
    )
    payload = F.to_json(document, {"ignoreNullFields": "false"})
    return counts.join(items, "run_date", "left").select("run_date", payload.alias("payload"))


def write_documents(documents: DataFrame, path: str) -> None:
    """One folder per run date; a rerun replaces the dates it covers and no others."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").text(path)


def digest_messages(digest: DataFrame, counts: DataFrame) -> DataFrame:
    """(run_date, message): the text sent for each run date."""
    title = escape_html(truncate(F.coalesce("headline", F.lit("")), 140))
    symbol = escape_html(F.coalesce(filled(F.col("symbol")), F.lit(NO_SYMBOL)))
    linked = F.concat(F.lit('<a href="'), escape_html(F.col("url")), F.lit('">'), title, F.lit("</a>"))
    entry = F.concat(
        F.lit("<b>"), symbol, F.lit("</b> · <i>"), escape_html(F.col("reason")), F.lit("</i>\n"),
        F.when(filled(F.col("url")).isNotNull(), linked).otherwise(title), F.lit("\n\n"),
    )
    head = F.concat(F.lit(f"<b>{MESSAGE_TITLE} — "), F.col("run_date").cast("string"), F.lit("</b>\n\n"))
    n = F.size("entries")
    some = F.concat(
        head, F.array_join("entries", ""), F.lit("<i>"), n.cast("string"), F.lit(" of "), counted(F.col("raw")),
        F.lit(" items ("), percent(compression(n, F.col("raw"))), F.lit(" filtered)</i>\n"), F.lit(DISCLAIMER),
    )
    none = F.concat(
        head, F.lit("Nothing crossed threshold today.\n<i>Scanned "), counted(F.col("raw")), F.lit(" items.</i>\n"),
        F.lit(DISCLAIMER),
    )
    joined = counts.join(_per_run(digest, entry, "entries"), "run_date", "left")
    return joined.select("run_date", F.when(n > 0, some).otherwise(none).alias("message"))


def digest_by_symbol(digest: DataFrame) -> DataFrame:
    """Headlines per symbol in order of first appearance, with the scores of the first one."""
    first = F.min_by(F.struct("volume_z", "return_z"), "rank")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "headline")))
    return (
        digest.groupBy("run_date", F.coalesce("symbol", F.lit("")).alias("symbol"))
        .agg(
            F.min("rank").alias("first_rank"),
            F.count(F.lit(1)).alias("headlines"),
            F.transform(ordered, lambda e: e["headline"]).alias("titles"),
            first.alias("first"),
        )
        .select("run_date", "symbol", "first_rank", "headlines", "titles", "first.volume_z", "first.return_z")
    )


def stage_bars(counts: DataFrame) -> DataFrame:
    """(run_date, position, stage, label, items, width): log-scaled bars, at least 2 percent wide."""
    largest = F.greatest(*STAGES, F.lit(1))
    bars = F.array(
        *(F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage"), F.lit(STAGE_LABELS[s]).alias("label"),
                   F.col(s).alias("items")) for i, s in enumerate(STAGES))
    )
    width = F.greatest(100 * F.ln(F.col("items") + 1) / F.ln(F.col("largest") + 1), F.lit(2.0))
    return (
        counts.select("run_date", largest.alias("largest"), F.inline(bars))
        .withColumn("width", width)
        .drop("largest")
    )


def local_time(instant: Column) -> Column:
    shown = F.date_format(F.from_utc_timestamp(instant, MARKET_ZONE), "d MMM yyyy, HH:mm")
    return F.concat(shown, F.lit(" WIB"))


def is_link(url: Column) -> Column:
    return F.coalesce(F.rlike(url, F.lit("^https?://")), F.lit(False))


def run_log(counts: DataFrame, trading: Column, started: Column, finished: Column, trigger: str | None = None) -> DataFrame:
    """One row per (run_date, trigger). ``counts`` may lack stages for days without a run."""
    zero = F.lit(0).cast("int")
    return counts.select(
        "run_date",
        F.lit(trigger or "local").alias("trigger"),
        F.when(trading, started).alias("started_at"),
        finished.alias("finished_at"),
        F.when(trading, F.lit("success")).otherwise("no_trading_day").alias("status"),
        F.lit(None).cast("string").alias("error"),
        *(
            F.when(trading, F.coalesce(F.col(s).cast("int"), zero)).otherwise(zero).alias(f"count_{s}")
            for s in STAGES
        ),
    )


def failed_run(failures: DataFrame, finished: Column, trigger: str | None = None) -> DataFrame:
    """Run-log rows for (run_date, error): no start, no counts, the error cut to 500 characters."""
    return failures.select(
        "run_date",
        F.lit(trigger or "local").alias("trigger"),
        F.lit(None).cast("timestamp").alias("started_at"),
        finished.alias("finished_at"),
        F.lit("failed").alias("status"),
        truncate(F.col("error"), 500).alias("error"),
        *(F.lit(0).cast("int").alias(f"count_{s}") for s in STAGES),
    )


def failure_alerts(log: DataFrame) -> DataFrame:
    """(run_date, alert) for every failed run."""
    text = F.concat(
        F.lit("<b>⚠️ Pipeline failed — "), F.col("run_date").cast("string"), F.lit("</b>\n\n<code>"),
        escape_html(truncate(F.coalesce("error", F.lit("")), 400)), F.lit("</code>"),
    )
    return log.where(F.col("status") == "failed").select("run_date", text.alias("alert"))


def recent_runs(log: DataFrame, size: int = 30) -> DataFrame:
    """The newest runs, oldest first."""
    newest = log.orderBy(F.col("run_date").desc(), F.col("trigger").desc()).limit(size)
    return newest.orderBy("run_date", "trigger")


def rekey_run_log(old: DataFrame) -> DataFrame:
    """Run-log rows of the older layout: adds missing counts, names the trigger."""
    upgraded = old if "count_watchlist" in old.columns else old.withColumn("count_watchlist", F.lit(0).cast("int"))
    return upgraded.withColumn("trigger", F.coalesce("trigger", F.lit("local")))


def unsent(counts: DataFrame, sent: DataFrame) -> DataFrame:
    """Run dates still to be delivered."""
    return counts.join(sent.select("run_date"), "run_date", "left_anti")


def mark_sent(delivered: DataFrame, at: Column) -> DataFrame:
    """Ledger rows for delivered run dates."""
    return delivered.select("run_date", at.alias("sent_at"), F.col("sent").cast("int").alias("item_count"))
