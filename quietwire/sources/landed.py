"""Landed JSON payloads -> cleaned rows. Whatever is rejected goes to a quarantine with its text, not away.

A landing table has one row per payload: ``payload`` (text), ``ordinal`` (anything that grows in the
order the payloads arrived) and, for prices, ``symbol`` (the one that was asked for). A payload is a
bare list of records or an envelope holding the list. Every record is parsed on its own, so a broken
one costs no other. A payload without a readable list is quarantined whole. Reading a folder of pages
puts the pages together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quietwire.functions.text import strip
from quietwire.functions.values import filled, normalise_symbol, stable_id, stripped_number
from quietwire.session import stage
from quietwire.settings import BROADCAST_WATCHLIST, LOOKBACK_DAYS

# Every value of a record as text; nested values keep their JSON form.
_RECORD = "map<string,string>"
_ENVELOPE_KEYS = ("results", "data")
_NUMBERS = ("close", "volume", "market_cap")


@dataclass(frozen=True)
class Cleaned:
    """``rows`` are good, ``quarantine`` (ordinal, position, raw, reason) is everything left out, and
    ``notes`` (the same columns) are values that had to be dropped from rows that were kept."""

    rows: DataFrame
    quarantine: DataFrame
    notes: DataFrame


def arrival() -> Column:
    """When a file landed: by time, then by the last number in its name, then by its full path."""
    name = F.col("_metadata.file_name")
    last = F.regexp_extract(name, r"(\d{1,18})\D*$", 1)
    return F.struct(
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.coalesce(last.try_cast("bigint"), F.lit(-1)).alias("number"),
        F.col("_metadata.file_path").alias("path"),
    ).alias("ordinal")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A folder of JSON files, one payload per file, in the order they landed."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"), arrival())


def records(landing: DataFrame) -> DataFrame:
    """One row per record: ``raw`` text, ``record`` (map of texts, null if it is none), ``position``.

    A payload without a readable list gives one row, with its whole text as ``raw`` and no position.
    """
    carried = [c for c in landing.columns if c != "payload"]
    # One step after the other, so that no payload is read twice; conditions on the lists wait until they are split for that.
    opened = landing.select(*carried, F.regexp_replace("payload", "^\ufeff", "").alias("_payload"))
    bare = F.rlike("_payload", F.lit(r"^\s*\["))
    envelope = F.from_json("_payload", "struct<" + ",".join(f"{key}:string" for key in _ENVELOPE_KEYS) + ">")
    opened = opened.withColumn("_envelope", F.when(~bare, envelope))
    listed = F.when(bare, F.col("_payload")).otherwise(F.coalesce(*(filled(F.col("_envelope")[key]) for key in _ENVELOPE_KEYS)))
    split = opened.select(*carried, "_payload", F.from_json(listed, "array<string>").alias("_elements"))
    split = split.withColumn("_unreadable", F.col("_elements").isNull())
    rows = split.select(*carried, "_payload", "_unreadable", F.posexplode_outer("_elements").alias("position", "_element"))
    rows = rows.where(F.col("position").isNotNull() | F.col("_unreadable"))  # an empty list holds nothing to keep
    raw = F.when(F.col("position").isNull(), F.col("_payload")).otherwise(F.coalesce("_element", F.lit("null")))
    return rows.select(*carried, "position", raw.alias("raw"), F.from_json("_element", _RECORD).alias("record"))


def _first(reasons: dict[str, Column]) -> Column:
    """The first of these conditions that holds, by name."""
    return F.coalesce(*(F.when(condition, name) for name, condition in reasons.items()))


def _rejects(parsed: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """The rows that fail any of the conditions, under the first one they fail."""
    return parsed.select("ordinal", "position", "raw", _first(reasons).alias("reason")).where(F.col("reason").isNotNull())


def _unreadable() -> dict[str, Column]:
    return {"no list": F.col("position").isNull(), "no record": F.col("record").isNull()}


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. Tasks combine first, so a key repeated everywhere is no hot spot."""
    values = [c for c in rows.columns if c not in keys]
    latest = F.max(F.struct(F.struct(*order).alias("o"), F.struct(*values).alias("v")))
    return rows.groupBy(*keys).agg(latest.alias("last")).select(*keys, "last.v.*").select(*rows.columns)


def price_rows(landing: DataFrame) -> Cleaned:
    """daily_close rows. The symbol of the record (or its ticker) wins over the one asked for.

    A close that does not fit its column rejects the record; a volume or market value that does not
    is left out and noted. Fractions of a volume are rounded.
    """
    record = F.col("record")
    asked = F.col("symbol") if "symbol" in landing.columns else F.lit(None).cast("string")
    # Texts are cleaned in a step of their own, as what follows names each of them more than once.
    cleaned = {f"_{c}": normalise_symbol(record[c]) for c in ("symbol", "ticker")} | {f"_{c}": strip(record[c]) for c in _NUMBERS}
    numbers = {f"_{c}": stripped_number(F.col(f"_{c}")) for c in _NUMBERS}
    parsed = records(landing).withColumns(cleaned).withColumns(numbers).select(
        F.coalesce(filled(F.col("_symbol")), filled(F.col("_ticker")), normalise_symbol(asked)).alias("symbol"),
        filled(record["date"]).try_cast("date").alias("trade_date"),
        F.col("_close").try_cast("decimal(20,4)").alias("close"),
        F.rint("_volume").try_cast("bigint").alias("volume"),
        F.col("_market_cap").try_cast("decimal(24,2)").alias("market_cap"),
        *(F.col(f"_{c}").isNotNull().alias(f"_has_{c}") for c in _NUMBERS),
        "ordinal",
        "position",
        "record",
        "raw",
    )
    rejects = _unreadable() | {f"no {c}": F.col(c).isNull() for c in ("symbol", "trade_date", "close")}
    lost = {f"{c} out of range": F.col(f"_has_{c}") & F.col(c).isNull() for c in ("volume", "market_cap")}
    # Written once: every record is parsed a single time, whichever of the three are read, and only texts that were left out are kept.
    judged = parsed.withColumns({"rejected": _first(rejects), "noted": _first(lost)})
    left_out = F.col("rejected").isNotNull() | F.col("noted").isNotNull()
    judged = stage(judged.withColumn("raw", F.when(left_out, F.col("raw"))).drop("record", *(f"_has_{c}" for c in _NUMBERS)), "parsed-prices")
    whole = judged.where("rejected IS NULL")
    rows = last_per_key(whole.drop("raw", "rejected", "noted"), ["symbol", "trade_date"], ["ordinal", "position"])
    found = (df.select("ordinal", "position", "raw", F.col(c).alias("reason")).where(F.col("reason").isNotNull()) for df, c in ((judged, "rejected"), (whole, "noted")))
    return Cleaned(rows.drop("ordinal", "position"), *found)


def news_rows(landing: DataFrame, watchlist: DataFrame) -> Cleaned:
    """news_items rows, one per id: the last record seen."""
    record = F.col("record")
    parsed = records(landing).select(
        stable_id(record, F.col("raw")).alias("id"),
        F.from_json(record["symbols"], "array<string>").alias("symbols"),
        record["timestamp"].try_cast("timestamp").alias("published_at"),
        strip(record["title"]).alias("title"),
        record["body"].alias("body"),
        record["source"].alias("source"),
        record["source"].alias("url"),
        "ordinal",
        "position",
        "record",
        "raw",
    )
    titled = F.coalesce(F.col("title") != "", F.lit(False))
    whole = titled & F.col("published_at").isNotNull() & record.isNotNull()
    rows = last_per_key(parsed.where(whole).drop("record", "raw"), ["id"], ["ordinal", "position"])
    rows = primary_symbol(rows, watchlist).select("id", "symbol", "published_at", "title", "body", "source", "url")
    rejects = _unreadable() | {"no title": ~titled, "no timestamp": F.col("published_at").isNull()}
    return Cleaned(rows, _rejects(parsed, rejects), _rejects(parsed.where(F.lit(False)), {"none": F.lit(False)}))


def primary_symbol(rows: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Adds ``symbol``: the first of ``symbols`` that is watched, else the first, else null."""
    mentioned = F.transform(F.filter("symbols", lambda s: filled(s).isNotNull()), normalise_symbol)
    watched = watchlist.select("symbol").distinct()
    if watched.count() <= BROADCAST_WATCHLIST:
        # A short list travels inside the expression.
        listed = F.lit([r["symbol"] for r in watched.collect()]).cast("array<string>")
        hit = F.filter(mentioned, lambda s: F.array_contains(listed, s))
        return rows.withColumn("symbol", F.coalesce(F.get(hit, F.lit(0)), F.get(mentioned, F.lit(0)))).drop("symbols")
    pairs = rows.select("id", F.posexplode(mentioned).alias("at", "symbol"))
    hits = (
        pairs.join(watched, "symbol", "left_semi").groupBy("id").agg(F.min_by("symbol", "at").alias("hit"))
    )
    first = F.get(mentioned, F.lit(0))
    return (
        rows.withColumn("first", first).join(hits, "id", "left")
        .withColumn("symbol", F.coalesce("hit", "first")).drop("hit", "first", "symbols")
    )


def lookback(rows: DataFrame, run_date, day: str = "trade_date", days: int = LOOKBACK_DAYS) -> DataFrame:
    """The landed rows a run takes in again, so that a missed run heals itself."""
    run_date = F.lit(run_date).cast("date")
    return rows.where(F.col(day).between(F.date_sub(run_date, days), run_date))


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows plus their count, taken while they are written."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen
