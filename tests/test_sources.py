import hashlib
import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quietwire.functions.values import normalise_symbol, number
from quietwire.plans import report
from quietwire.sources.landed import counted, lookback, news_rows, price_rows, read_landing
from quietwire.sources.tables import create_table, read_table, upsert
from quietwire.streaming import arrivals


@pytest.mark.parametrize("raw,symbol", [
    ("BBCA", "BBCA"), ("bbca", "BBCA"), (" bbca.jk ", "BBCA"), ("A.JK.JK", "A.JK"), ("", None), (None, None),
])
def test_symbol(spark, raw, symbol):
    assert spark.createDataFrame([(raw,)], "s string").select(normalise_symbol(F.col("s"))).first()[0] == symbol


@pytest.mark.parametrize("raw,value", [
    ("1.5", 1.5), (" -2e3 ", -2000.0), ("1_000", 1000.0), (".5", 0.5), ("7.", 7.0),
    ("", None), ("-", None), ("1,234", None), ("1.5d", None), ("nan", None), ("inf", None), (None, None),
])
def test_number(spark, raw, value):
    assert spark.createDataFrame([(raw,)], "s string").select(number(F.col("s"))).first()[0] == value


def _landing(spark, *payloads, symbol="BBCA"):
    rows = [(symbol, i, json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "symbol string, ordinal int, payload string")


def test_bare_list_of_prices(spark):
    raw = [{"symbol": "Hrb7.jk", "date": "2025-02-11", "close": 412.5, "volume": 90210, "market_cap": 31000000000.25}]
    row = price_rows(_landing(spark, raw)).rows.first()
    assert (row.symbol, row.trade_date, float(row.close), row.volume) == ("HRB7", date(2025, 2, 11), 412.5, 90210)
    assert float(row.market_cap) == 31000000000.25


def test_envelopes_tickers_and_rejects(spark):
    good = {"date": "2026-09-18", "close": "10"}
    cleaned = price_rows(_landing(
        spark,
        {"results": [{**good, "ticker": "tlkm"}], "pagination": {"has_next": False}},
        {"data": [{**good, "symbol": ""}, {**good, "close": None}, {"close": 3}, {**good, "date": "soon"}]},
        {"error": "no list"},
    ))
    assert {r.symbol for r in cleaned.rows.collect()} == {"TLKM", "BBCA"}
    left_out = [(r.ordinal, r.position, r.reason) for r in cleaned.quarantine.orderBy("ordinal", "position").collect()]
    assert left_out == [(1, 1, "no close"), (1, 2, "no trade_date"), (1, 3, "no trade_date"), (2, None, "no list")]


def test_pages_add_up(spark):
    sizes = (40, 1, 0, 17)
    pages = [{"results": [{"symbol": f"P{p}N{i}", "date": "2025-02-12", "close": 1 + i} for i in range(n)]} for p, n in enumerate(sizes)]
    cleaned = price_rows(_landing(spark, *pages))
    assert cleaned.rows.count() == sum(sizes)
    assert cleaned.quarantine.count() == 0


def _texts(spark, *payloads):
    return spark.createDataFrame([("HRB", i, p) for i, p in enumerate(payloads)], "symbol string, ordinal int, payload string")


def test_nothing_is_lost_without_a_trace(spark):
    good = '{"date":"2025-02-13","close":5,"volume":2.7}'
    cleaned = price_rows(_texts(
        spark,
        f"[{good}",  # cut off
        f'[7, {good.replace("13", "14")}, "x", null]',
        f"\ufeff[{good}]",
        "no json at all",
        '[{"date":"2025-02-15","close":1e30}, {"date":"2025-02-16","close":2,"volume":1e30}]',
        None,
        "[]",
    ))
    rows = {str(r.trade_date): (float(r.close), r.volume) for r in cleaned.rows.collect()}
    assert rows == {"2025-02-14": (5.0, 3), "2025-02-13": (5.0, 3), "2025-02-16": (2.0, None)}
    left_out = {(r.ordinal, r.position, r.reason) for r in cleaned.quarantine.collect()}
    assert left_out == {
        (0, None, "no list"), (1, 0, "no record"), (1, 2, "no record"), (1, 3, "no record"), (3, None, "no list"), (4, 0, "no close"), (5, None, "no list"),
    }
    assert {r.raw for r in cleaned.quarantine.where("ordinal in (0, 3)").collect()} == {f"[{good}", "no json at all"}
    assert [(r.ordinal, r.position, r.reason) for r in cleaned.notes.collect()] == [(4, 1, "volume out of range")]


def test_later_pages_win_by_time_then_number(spark, tmp_path):
    for name, close, at in (("page-10.json", 10, 1_000), ("page-9.json", 9, 1_000), ("page-2.json", 2, 500)):
        (tmp_path / name).write_text(json.dumps([{"symbol": "HRB", "date": "2025-02-17", "close": close}]))
        os.utime(tmp_path / name, (at, at))
    assert float(price_rows(read_landing(spark, str(tmp_path))).rows.first().close) == 10.0
    os.utime(tmp_path / "page-2.json", (2_000, 2_000))
    assert float(price_rows(read_landing(spark, str(tmp_path))).rows.first().close) == 2.0


@pytest.mark.parametrize("raw,own", [("0", None), ("false", None), ('""', None), ("null", None), ('"0"', "0"), ("true", "True"), ("12", "12"), ('"k"', "k")])
def test_ids_that_count(spark, raw, own):
    page = f'[{{"id":{raw},"title":"t","timestamp":"2025-02-18T00:00:00Z"}}]'
    found = news_rows(_texts(spark, page), spark.createDataFrame([], "symbol string")).rows.first().id
    assert found == (own or hashlib.sha1(b"t||").hexdigest())


def test_news(spark):
    base = {"title": " Hello ", "body": "b", "source": "http://u", "timestamp": "2026-09-14T01:02:03Z"}
    cleaned = news_rows(_landing(
        spark,
        {"results": [
            {**base, "symbols": ["aaaa.jk", "TLKM.JK"]},
            {**base, "title": "   "},
            {**base, "id": 17, "symbols": None, "body": "first"},
            {**base, "id": "18", "timestamp": None},
        ]},
        [{**base, "id": 17, "symbols": ["zzzz", ""], "body": "second"}],
    ), spark.createDataFrame([("TLKM",)], "symbol string"))
    rows = {r.id: r for r in cleaned.rows.collect()}
    hashed = rows[hashlib.sha1(b" Hello |http://u|").hexdigest()]
    assert (hashed.symbol, hashed.title, hashed.url) == ("TLKM", "Hello", "http://u")
    assert hashed.published_at == datetime(2026, 9, 14, 1, 2, 3)
    assert (rows["17"].symbol, rows["17"].body) == ("ZZZZ", "second")
    assert cleaned.quarantine.count() == 2


def test_upsert_modes(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, note string")
    new = spark.createDataFrame([("b", None), ("c", 9)], "k string, v int")
    assert sorted(upsert(old, new, ["k"]).collect()) == sorted([("a", 1, "x"), ("b", None, "y"), ("c", 9, None)])
    assert upsert(old, new, ["k"], update=[]).collect() == upsert(old, new, ["k"]).collect()
    kept = {r.k: r.v for r in upsert(old, new, ["k"], insert_only=True).collect()}
    assert kept == {"a": 1, "b": 2, "c": 9}


def test_lookback_heals_a_lost_day(spark):
    rows = spark.createDataFrame([("A", date(2026, 9, d)) for d in range(1, 30)], "symbol string, trade_date date")
    assert lookback(rows, date(2026, 9, 20)).count() == 8


def test_row_count_comes_with_the_write(spark):
    rows, seen = counted(spark.range(5), "written")
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 5


def test_rekeyed_log_is_unique(spark):
    old = spark.createDataFrame([(date(2026, 9, 1), None), (date(2026, 9, 2), "schedule")], "run_date date, trigger string")
    new = report.rekey_run_log(old).collect()
    assert {(r.run_date.day, r.trigger, r.count_watchlist) for r in new} == {(1, "local", 0), (2, "schedule", 0)}


def test_nightly_intake_is_idempotent(spark, tmp_path):
    landing, table, seen = (str(tmp_path / n) for n in ("landing", "daily_close", "seen"))
    (tmp_path / "landing").mkdir()

    def land(name, *rows):
        records = [{"symbol": s, "date": d, "close": c, "volume": 1} for s, d, c in rows]
        (tmp_path / "landing" / name).write_text(json.dumps(records))

    def stored():
        return {(r.symbol, str(r.trade_date)): float(r.close) for r in read_table(spark, table, arrivals.PRICES).collect()}

    create_table(spark, table, arrivals.PRICES, "year")
    land("1.json", ("A", "2025-12-31", 1), ("A", "2026-01-02", 2))
    arrivals.take_in_prices(spark, landing, table, seen)
    assert stored() == {("A", "2025-12-31"): 1.0, ("A", "2026-01-02"): 2.0}
    land("2.json", ("A", "2026-01-02", 3), ("B", "2026-01-02", 4))
    arrivals.take_in_prices(spark, landing, table, seen)
    after = stored()
    assert after == {("A", "2025-12-31"): 1.0, ("A", "2026-01-02"): 3.0, ("B", "2026-01-02"): 4.0}
    arrivals.take_in_prices(spark, landing, table, seen)
    assert stored() == after


def test_news_keeps_its_partition(spark, tmp_path):
    landing, table, seen = (str(tmp_path / n) for n in ("landing", "news", "seen"))
    (tmp_path / "landing").mkdir()
    create_table(spark, table, arrivals.NEWS, "published_date")
    watch = spark.createDataFrame([("A",)], "symbol string")
    for name, at, body in (("1", "2026-09-14T23:00:00Z", "old"), ("2", "2026-09-15T01:00:00Z", "new")):
        (tmp_path / "landing" / f"{name}.json").write_text(json.dumps({"results": [{"id": "n", "title": "t", "timestamp": at, "body": body}]}))
        arrivals.take_in_news(spark, landing, table, seen, watch)
    rows = read_table(spark, table, arrivals.NEWS).collect()
    assert [(r.body, str(r.published_date), r.published_at.hour) for r in rows] == [("new", "2026-09-14", 1)]


def test_payloads_and_records_are_read_once(spark, monkeypatch):
    from quietwire.sources import landed

    plans = []

    def kept(df, label, real=landed.stage):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(landed, "stage", kept)
    pages = ['{"results":[{"symbol":"ab","date":"2025-01-02","close":"1.5"},7]}', "[]", "[{", '[{"ticker":"cd","date":"2025-01-02","close":"1","volume":1e30}]']
    cleaned = price_rows(spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "ordinal int, payload string"))
    assert {r.symbol for r in cleaned.rows.collect()} == {"AB", "CD"}
    assert {(r.ordinal, r.position, r.raw, r.reason) for r in cleaned.quarantine.collect()} == {(0, 1, "7", "no record"), (2, None, "[{", "no list")}
    assert [(r.ordinal, r.position, r.reason) for r in cleaned.notes.collect()] == [(3, 0, "volume out of range")]
    assert [(p.count("from_json(ArrayType"), p.count("from_json(StructField"), p.count("from_json(MapType")) for p in plans] == [(1, 1, 1)]
