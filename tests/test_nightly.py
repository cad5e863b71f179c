"""The nightly job on stored tables, table sinks, staging and skew bounds."""

import json
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quietwire import schema, session
from quietwire.operators import skew
from quietwire.operators.baselines import baselines
from quietwire.operators.watchlist import mark_watched
from quietwire.plans import nightly
from quietwire.sources import tables
from quietwire.sources.tables import create_table, manifest, read_table, replace_table, upsert_partitions, vacuum
from quietwire.streaming.arrivals import NEWS, PRICES

START = date(2025, 10, 1)
DAYS = [START + timedelta(days=i) for i in range(60)]
LAST = date(2025, 11, 28)  # a Friday


def _prices(spark, days=DAYS):
    rows = []
    for s, symbol in enumerate(("Q1", "Q2", "Q3")):
        for i, day in enumerate(days):
            volume = 500 + (i * 13 + s) % 40 + (9000 if day == LAST and symbol != "Q3" else 0)
            rows.append((symbol, day, 20 + (i * 7 + s) % 6, volume))
    out = spark.createDataFrame(rows, "symbol string, trade_date date, close int, volume bigint")
    return out.select("symbol", "trade_date", F.col("close").cast("decimal(20,4)").alias("close"), "volume",
                      F.lit(None).cast("decimal(24,2)").alias("market_cap"))


def _news(spark):
    rows = [(f"n{i}", ("Q1", "Q2", "Q3")[i % 3], datetime(2025, 11, 28, i % 24, 5), f"item {i} of the day", f"http://q/{i}") for i in range(30)]
    rows += [("old", "Q1", datetime(2025, 11, 27, 4, 5), "the day before", None), ("weekend", "Q2", datetime(2025, 11, 29, 9, 0), "Saturday", None)]
    out = spark.createDataFrame(rows, "id string, symbol string, published_at timestamp, title string, url string")
    return out.withColumns({"body": F.lit(None).cast("string"), "source": F.col("url"), "fetched_at": F.current_timestamp(),
                            "published_date": F.to_date("published_at")}).select(*NEWS.names)


@pytest.fixture()
def store(spark, tmp_path):
    made = nightly.Store(str(tmp_path / "store"))
    made.create(spark, ["Q1", "Q2"])
    nightly.take_in_again(made, _prices(spark), DAYS[-1], days=400)
    upsert_partitions(spark, made.path("news_items"), NEWS, _news(spark), ["id"], "published_date")
    return made


def _snapshot(spark, store):
    out = {}
    for table, kind in (("baselines", nightly.BASELINES), ("item_scores", nightly.SCORES), ("sent_digests", nightly.LEDGER), ("run_log", nightly.LOG)):
        rows = store.read(spark, table, kind).drop("sent_at", "started_at", "finished_at")
        out[table] = sorted(map(str, rows.collect()))
    return out


def test_a_run_fills_every_table_and_a_rerun_changes_nothing(spark, store):
    asked = [LAST - timedelta(days=1), LAST, LAST + timedelta(days=1)]
    messages = {r.run_date: r.message for r in nightly.run(spark, store, asked, "schedule").collect()}
    assert set(messages) == set(asked[:2])
    assert "<b>Q1</b>" in messages[LAST] and "Nothing crossed" in messages[asked[0]]
    log = {r.run_date: r for r in store.read(spark, "run_log", nightly.LOG).collect()}
    assert [log[d].status for d in asked] == ["success", "success", "no_trading_day"]
    assert (log[LAST].count_raw, log[asked[0]].count_raw, log[asked[2]].count_raw) == (30, 1, 0)
    assert log[LAST].count_sent == min(10, log[LAST].count_watchlist) > 0
    assert nightly.confirm(spark, store, asked) == 2
    ledger = {r.run_date: r.item_count for r in store.read(spark, "sent_digests", nightly.LEDGER).collect()}
    assert ledger == {LAST: log[LAST].count_sent, asked[0]: 0}
    scores = store.read(spark, "item_scores", nightly.SCORES)
    assert scores.count() == 31 and scores.where("passed_stage = 'sent'").count() == ledger[LAST]
    documents = {r.run_date: json.loads(r.value) for r in spark.read.text(store.path("digests")).collect()}
    assert len(documents[LAST]["items"]) == ledger[LAST]
    want = baselines(_prices(spark)).where(F.col("trade_date").between(asked[0], LAST)).select("symbol", "trade_date", "vol_mean_30d", "n_obs")
    got = store.read(spark, "baselines", nightly.BASELINES).select("symbol", "trade_date", "vol_mean_30d")
    assert sorted(got.collect()) == sorted(want.drop("n_obs").collect())
    before = _snapshot(spark, store)
    assert nightly.run(spark, store, asked, "schedule").count() == 0
    assert _snapshot(spark, store) == before


def test_lookback_heals_a_removed_day(spark, store):
    lost = LAST - timedelta(days=3)
    replace_table(spark, store.path("daily_close"), store.read(spark, "daily_close", PRICES).where(F.col("trade_date") != F.lit(lost)), "year")
    assert store.read(spark, "daily_close", PRICES).where(F.col("trade_date") == F.lit(lost)).isEmpty()
    assert nightly.take_in_again(store, _prices(spark), LAST) == 24
    assert store.read(spark, "daily_close", PRICES).count() == 180
    assert store.read(spark, "daily_close", PRICES).where(F.col("trade_date") == F.lit(lost)).count() == 3


def test_a_run_heals_lost_days_by_itself(spark, store, monkeypatch):
    lost = [LAST - timedelta(days=3), LAST]
    kept = store.read(spark, "daily_close", PRICES).where(~F.col("trade_date").isin(lost) | (F.col("symbol") == "Q2"))
    replace_table(spark, store.path("daily_close"), kept, "year")
    message = nightly.run(spark, store, [LAST], landed=_prices(spark)).first().message
    assert "<b>Q1</b>" in message
    assert store.read(spark, "daily_close", PRICES).count() == 180
    want = baselines(_prices(spark)).where(F.col("trade_date").between(lost[0], LAST)).select("symbol", "trade_date", "vol_mean_30d")
    got = store.read(spark, "baselines", nightly.BASELINES).select("symbol", "trade_date", "vol_mean_30d")
    assert sorted(got.collect()) == sorted(want.collect())
    # Nothing is lost now, so nothing is written.
    before = manifest(spark, store.path("daily_close"))
    assert nightly.heal(store, _prices(spark), LAST, LAST) == []
    assert manifest(spark, store.path("daily_close")) == before


def test_a_failure_is_logged_and_raised(spark, store, monkeypatch):
    def fail(*_):
        raise RuntimeError("no disk left " + "x" * 600)

    monkeypatch.setattr(nightly.funnel, "item_stages", fail)
    with pytest.raises(RuntimeError):
        nightly.run(spark, store, [LAST])
    (row,) = store.read(spark, "run_log", nightly.LOG).collect()
    assert (row.status, row.trigger, len(row.error), row.count_raw) == ("failed", "local", 500, 0)
    assert store.read(spark, "sent_digests", nightly.LEDGER).isEmpty()
    (alert,) = nightly.pending(spark, store).collect()
    assert (alert.run_date, alert.kind) == (LAST, nightly.ALERT) and "no disk left" in alert.message
    # The alert goes out; the date stays open.
    assert nightly.deliver(spark, store, lambda *_: None) == [(LAST, nightly.ALERT)]
    assert nightly.pending(spark, store).isEmpty() and store.read(spark, "sent_digests", nightly.LEDGER).isEmpty()


def test_a_lost_message_is_offered_again(spark, store, monkeypatch):
    asked = [LAST - timedelta(days=1), LAST]
    first = {r.run_date: r.message for r in nightly.run(spark, store, asked).collect()}
    sent = []

    def send(day, kind, message):
        if day == LAST and not sent[1:]:
            sent.append(None)
            raise ConnectionError("line is down")
        sent.append((day, message))

    with pytest.raises(ConnectionError):
        nightly.deliver(spark, store, send)
    assert [r.run_date for r in store.read(spark, "sent_digests", nightly.LEDGER).collect()] == asked[:1]
    # The next run offers the same message and works nothing out again.
    monkeypatch.setattr(nightly.funnel, "item_stages", lambda *_: pytest.fail("worked out again"))
    assert {r.run_date: r.message for r in nightly.run(spark, store, asked).collect()} == {LAST: first[LAST]}
    assert nightly.deliver(spark, store, send) == [(LAST, nightly.DIGEST)]
    assert sent == [(asked[0], first[asked[0]]), None, (LAST, first[LAST])]
    assert nightly.confirm(spark, store, asked) == 0 and nightly.deliver(spark, store, send) == []
    ledger = store.read(spark, "sent_digests", nightly.LEDGER)
    assert sorted(r.run_date for r in ledger.collect()) == asked
    assert nightly.run(spark, store, asked).isEmpty()


def test_a_crash_while_confirming_sends_nothing_twice(spark, store, monkeypatch):
    nightly.run(spark, store, [LAST]).collect()
    write = nightly._write
    monkeypatch.setattr(nightly, "_write", lambda store, table, *rest: (_ for _ in ()).throw(OSError("gone")) if table == "outbox" else write(store, table, *rest))
    with pytest.raises(OSError):
        nightly.confirm(spark, store, [LAST])
    monkeypatch.undo()
    assert nightly.pending(spark, store).isEmpty()
    nightly.confirm(spark, store, [LAST])
    assert store.read(spark, "outbox", nightly.OUTBOX).where("delivered_at is null").isEmpty()


def _years(spark, close):
    rows = spark.createDataFrame([("A", date(y, 1, 2)) for y in (2001, 2002, 2003)], "symbol string, trade_date date")
    return rows.select("symbol", "trade_date", F.lit(close).cast("decimal(20,4)").alias("close"), F.lit(7).cast("bigint").alias("volume"),
                       F.lit(None).cast("decimal(24,2)").alias("market_cap"), F.current_timestamp().alias("fetched_at"),
                       F.year("trade_date").alias("year")).select(*PRICES.names)


def _closes(spark, path):
    return {r.year: int(r.close) for r in read_table(spark, path, PRICES).collect()}


@pytest.mark.parametrize("at", ["_added", "_commit"])
def test_a_crash_leaves_the_old_table(spark, tmp_path, monkeypatch, at):
    path, keys = str(tmp_path / "t"), ["symbol", "trade_date"]
    create_table(spark, path, PRICES, "year")
    upsert_partitions(spark, path, PRICES, _years(spark, 1), keys, "year", follows=True)
    before = manifest(spark, path)
    reading = read_table(spark, path, PRICES)
    real = getattr(tables, at)

    def crash(*args):
        if at == "_added":
            real(*args)  # the files are there, the manifest is not
        raise OSError("killed")

    monkeypatch.setattr(tables, at, crash)
    with pytest.raises(OSError):
        upsert_partitions(spark, path, PRICES, _years(spark, 2).where("year > 2001"), keys, "year", follows=True)
    assert manifest(spark, path) == before and _closes(spark, path) == {2001: 1, 2002: 1, 2003: 1}
    monkeypatch.undo()
    upsert_partitions(spark, path, PRICES, _years(spark, 2).where("year > 2001"), keys, "year", follows=True)
    assert _closes(spark, path) == {2001: 1, 2002: 2, 2003: 2}
    # A reader that began before still reads what it began with.
    assert {int(r.close) for r in reading.collect()} == {1}
    # Only the partitions that changed have new folders.
    old, new = before[1], manifest(spark, path)[1]
    assert {k for k in new if new[k] != old[k]} == {"year=2002", "year=2003"}
    assert vacuum(spark, path, keep=1) == 2 and _closes(spark, path) == {2001: 1, 2002: 2, 2003: 2}


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    create_table(spark, path, PRICES, "year")
    version, folders = manifest(spark, path)
    replace_table(spark, path, _years(spark, 1), "year")
    with pytest.raises(RuntimeError, match="another writer"):
        tables._commit(spark, path, version + 1, folders)
    assert _closes(spark, path) == {2001: 1, 2002: 1, 2003: 1}


def test_a_plain_folder_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    _years(spark, 1).write.partitionBy("year").parquet(path)
    assert _closes(spark, path) == {2001: 1, 2002: 1, 2003: 1}
    upsert_partitions(spark, path, PRICES, _years(spark, 5).where("year = 2002"), ["symbol", "trade_date"], "year", follows=True)
    assert _closes(spark, path) == {2001: 1, 2002: 5, 2003: 1}


def test_seed_survives_a_crash(spark, store, monkeypatch):
    monkeypatch.setattr(tables, "_commit", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        store.seed(spark, ["Q9"])
    monkeypatch.undo()
    assert sorted(r.symbol for r in store.read(spark, "watchlist", schema.WATCHLIST).collect()) == ["Q1", "Q2"]


def test_seed_keeps_what_is_there(spark, store):
    store.seed(spark, ["Q2", "Q7"])
    assert sorted(r.symbol for r in store.read(spark, "watchlist", schema.WATCHLIST).collect()) == ["Q1", "Q2", "Q7"]


def test_only_touched_partitions_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create_table(spark, path, PRICES, "year")
    rows = spark.createDataFrame([("A", date(y, 1, 2), y) for y in range(2001, 2011)], "symbol string, trade_date date, close int")
    rows = rows.select("symbol", "trade_date", F.col("close").cast("decimal(20,4)").alias("close"), F.year("trade_date").alias("year"))
    upsert_partitions(spark, path, PRICES, rows, ["symbol", "trade_date"], "year", follows=True)
    seen = []
    keep = session.stage
    monkeypatch.setattr("quietwire.sources.tables.stage", lambda df, label: (seen.append(df), keep(df, label))[1])
    change = rows.where("year in (2003, 2007)").withColumn("close", F.col("close") + 1)
    upsert_partitions(spark, path, PRICES, change.withColumn("close", F.col("close").cast("decimal(20,4)")), ["symbol", "trade_date"], "year", follows=True)
    plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
    (filters,) = {x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]} - {""}
    assert "2003" in filters and "2007" in filters
    closes = {r.year: int(r.close) for r in read_table(spark, path, PRICES).collect()}
    assert closes == {y: y + (y in (2003, 2007)) for y in range(2001, 2011)}


def test_no_folder_on_a_cluster_is_an_error():
    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)


def test_release_removes_what_was_staged(spark):
    df = session.stage(spark.range(3), "passing")
    (file, *_) = df.inputFiles()
    assert df.count() == 3
    from pathlib import Path

    assert Path(file.removeprefix("file://")).exists()
    folder = Path(session._own_folder(spark).removeprefix("file:"))
    kept = list(folder.iterdir())
    session.release(spark)
    assert kept and not folder.exists()


def test_a_key_is_split_by_its_rows_whatever_the_total(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    counts = spark.createDataFrame([("a", 99), ("b", 101), ("c", 1000)], "k string, n bigint")
    assert {r.k: r["_salts"] for r in skew.hot_keys(counts, ["k"], "n").collect()} == {"b": 2, "c": 10}
    big = spark.range(1101).selectExpr("if(id < 1000, 'c', if(id < 1099, 'b', 'a')) as k", "id")
    small = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    joined = skew.salted_join(big, small, ["k"], skew.hot_keys(counts, ["k"], "n"), F.col("id"))
    assert joined.groupBy("k").count().orderBy("k").collect() == [("a", 2), ("b", 99), ("c", 1000)]


def test_a_long_watchlist_is_joined(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    items = spark.createDataFrame([(i, s) for i, s in enumerate(["q1", "Q2", None, "", "Q3"])], "id int, symbol string")
    listed = spark.createDataFrame([("Q1",), ("q3",), ("Q3",)], "symbol string")
    assert {r.id for r in mark_watched(items, listed).where("watched").collect()} == {0, 4}


def test_partitions_follow_the_input(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    session.configure(spark, 100 << 40)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) == 100 * 4096
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    if before:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before)
