from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quietwire.operators.baselines import baselines, baselines_since
from quietwire.operators.coverage import backfill_gaps, backfill_windows
from quietwire.operators.market_calendar import is_trading_day, last_closed_session, latest_trading_day
from quietwire.operators.skew import number_rows
from quietwire.operators.surprise import is_surprising, reason, score, zscore
from quietwire.operators.watchlist import mark_watched
from quietwire.plans import evaluate, funnel, report
from quietwire.settings import Thresholds

_SCORED = (
    "id string, symbol string, volume bigint, vol_mean_30d double, vol_std_30d double, daily_return double, "
    "ret_mean_30d double, ret_std_30d double, n_obs int"
)


def _score(spark, *values):
    return score(spark.createDataFrame([values], _SCORED)).withColumn("hit", is_surprising()).first()


@pytest.mark.parametrize("value,mean,std,z", [
    (120, 100.0, 10.0, 2.0), (80, 100.0, 10.0, -2.0), (100, 100.0, 0.0, None), (None, 100.0, 10.0, None), (100, None, 10.0, None),
])
def test_zscore(spark, value, mean, std, z):
    row = spark.createDataFrame([(value, mean, std)], "v bigint, m double, s double")
    assert row.select(zscore(F.col("v"), F.col("m"), F.col("s"))).first()[0] == z


def test_scoring(spark):
    row = _score(spark, "p", "Q1", 740, 500.0, 80.0, -0.03, 0.01, 0.02, 25)
    assert (row.volume_z, row.return_z, row.hit) == (3.0, -2.0, True)


def test_quiet_day(spark):
    row = _score(spark, "q", "Q2", 480, 500.0, 80.0, 0.02, 0.01, 0.02, 25)
    assert (row.volume_z, row.return_z, row.hit) == (-0.25, 0.5, False)


@pytest.mark.parametrize("n_obs,scored", [(0, False), (9, False), (10, True), (30, True)])
def test_thin_baselines_are_not_scored(spark, n_obs, scored):
    row = _score(spark, "r", "Q3", 9_999, 10.0, 2.0, 0.5, 0.0, 0.1, n_obs)
    assert (row.volume_z is not None, row.return_z is not None, row.hit) == (scored, scored, scored)


def test_thresholds_are_inclusive_and_named(spark):
    rows = spark.createDataFrame([(2.5, 0.0), (0.0, -2.0), (6.8, -3.4), (1.0, None)], "volume_z double, return_z double")
    got = rows.select(is_surprising().alias("hit"), reason().alias("why")).collect()
    assert [tuple(r) for r in got] == [
        (True, "volume +2.5s"), (True, "price -2.0s"), (True, "volume +6.8s, price -3.4s"), (False, "watchlist"),
    ]


def _watch(spark, *symbols):
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")


def test_watchlist_ignores_case_and_empty_means_all(spark):
    items = _watch(spark, "Q1", "q2", "Q3", "Q4", None)
    kept = mark_watched(items, _watch(spark, "q1", "Q2", "Q9")).where("watched").collect()
    assert {r.symbol for r in kept} == {"Q1", "q2"}
    assert mark_watched(items, _watch(spark)).where("watched").count() == 5


def _prices(spark, closes, volumes=None, start=date(2026, 1, 1), symbol="A"):
    rows = [(symbol, start + timedelta(days=i), c, (volumes or [1] * len(closes))[i]) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, close int, volume bigint").withColumn(
        "close", F.col("close").cast("decimal(20,4)")
    )


def test_baseline_leaves_out_its_own_day(spark):
    volumes = [10, 12] * 20 + [1000]
    last = baselines(_prices(spark, [100] * 41, volumes)).orderBy(F.col("trade_date").desc()).first()
    assert last.vol_mean_30d == 11.0
    assert last.n_obs == 30
    assert last.ret_std_30d == 0.0


def test_baseline_edges(spark):
    rows = baselines(_prices(spark, [100, 0, 50])).orderBy("trade_date").collect()
    assert [r.daily_return for r in rows] == [None, -1.0, None]
    assert rows[0].vol_mean_30d is None and rows[1].vol_std_30d is None


def test_incremental_baseline_equals_full(spark):
    prices = _prices(spark, [100 + (i * 37) % 11 for i in range(90)], [(i * 53) % 17 for i in range(90)])
    since = date(2026, 3, 1)
    full = baselines(prices).where(F.col("trade_date") >= F.lit(since))
    assert sorted(baselines_since(prices, since).collect()) == sorted(full.collect())


def test_calendar(spark):
    days = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("2026-01-03",)], "d string").select(F.to_date("d").alias("d"))
    got = days.select(is_trading_day(F.col("d")), latest_trading_day(F.col("d")).cast("string")).collect()
    assert [tuple(r) for r in got] == [(False, "2025-12-31"), (True, "2026-01-02"), (False, "2026-01-02")]


@pytest.mark.parametrize("instant,session", [
    ("2026-09-14 12:00:00", "2026-09-14"),   # 19:00 in Jakarta, session over
    ("2026-09-14 09:59:00", "2026-09-11"),   # 16:59 on a Monday
    ("2026-09-14 18:00:00", "2026-09-14"),   # past midnight in Jakarta
])
def test_last_closed_session(spark, instant, session):
    df = spark.createDataFrame([(instant,)], "t string").select(last_closed_session(F.to_timestamp("t")).cast("string"))
    assert df.first()[0] == session


def test_backfill_windows_drop_a_final_single_day(spark):
    start = date(2026, 1, 1)
    spans = backfill_windows(_watch(spark, "A"), start, start + timedelta(days=90)).collect()
    assert [(r.w_start, r.w_end) for r in spans] == [(start, start + timedelta(days=89))]
    spans = backfill_windows(_watch(spark, "A"), start, start + timedelta(days=91)).collect()
    assert [(r.w_end - r.w_start).days for r in spans] == [89, 1]


def test_backfill_gaps(spark):
    start = date(2026, 1, 1)
    gaps = backfill_gaps(_watch(spark, "A", "B"), _prices(spark, [1] * 54), start, start + timedelta(days=89)).collect()
    assert {r.symbol: (r.covered, r.span, r.needs_fetch) for r in gaps} == {"A": (54, 90, False), "B": (0, 90, True)}


def test_row_numbers_without_a_window(spark):
    rows = spark.createDataFrame([("a", i) for i in range(200)] + [("b", 5), ("b", 1)], "g string, v int")
    got = {(r.g, r.v): r.n for r in number_rows(rows.repartition(7), ["g"], ["v"], "n").collect()}
    assert all(got["a", i] == i + 1 for i in range(200))
    assert (got["b", 1], got["b", 5]) == (1, 2)


@pytest.fixture(scope="module")
def world(spark):
    """Two watched symbols and one other over 45 days; one watched symbol trades heavily on the last."""
    start = date(2026, 8, 1)
    frames = []
    for symbol, last in (("Q1", 7_700), ("Q2", 2_013), ("Q9", 8_800)):
        volumes = [2_000 + (i * 11) % 26 for i in range(44)] + [last]
        frames.append(_prices(spark, [60 + (i * 3) % 5 for i in range(45)], volumes, start, symbol))
    prices = frames[0].union(frames[1]).union(frames[2]).cache()
    day = "2026-09-14"
    kinds = ("shipping", "lending", "mining", "retail")
    rows = [
        (f"r{i}", f"Q{1 + i % 2}", f"{day} {(i * 5) % 24:02d}:15:00", f"{kinds[i % 4]} note {i} for subscribers", f"http://n/{i}")
        for i in range(36)
    ]
    rows += [
        ("heavy", "Q1", f"{day} 11:20:00", "Q1 pauses <deal> talks & buyers queue", "http://n/h?p=1&q=2"),
        ("apart", "Q9", f"{day} 11:20:00", "Q9 moves without a watcher", None),
        ("wide", None, f"{day} 11:20:00", "rain expected across the islands", None),
        ("before", "Q1", "2026-09-13 12:00:00", "a Sunday column", None),
    ]
    news = spark.createDataFrame(rows, "id string, symbol string, at string, title string, url string").select(
        "id", "symbol", F.to_timestamp("at").alias("published_at"), "title", F.lit(None).cast("string").alias("body"), "url"
    )
    watch = _watch(spark, "q1", "Q2")
    return news, prices, watch, funnel.item_stages(news, prices, watch)


def test_every_stage_is_part_of_the_one_before(world):
    news, prices, watch, stages = world
    (c,) = funnel.stage_counts(stages).collect()
    assert c.raw == 39
    assert c.raw >= c.deduped > c.surprising > c.watchlist >= c.sent > 0
    passed = {r.id: r.passed_stage for r in stages.collect()}
    assert (passed["heavy"], passed["apart"], passed["wide"]) == ("sent", "surprising", "deduped")
    assert "before" not in passed


def test_digest_equals_the_sent_stage(world):
    news, prices, watch, stages = world
    pruned = funnel.digest(news, prices, watch).orderBy("rank").collect()
    assert pruned == funnel.digest_of(stages, news).orderBy("rank").collect()
    assert "heavy" in {r.id for r in pruned}


def test_rank_orders_by_absolute_strength(spark):
    rows = spark.createDataFrame(
        [("k", -3.1, 0.4), ("l", None, 7.7), ("m", 4.2, -8.5), ("n", None, None)], "id string, volume_z double, return_z double"
    ).withColumn("run_date", F.lit("2026-09-14")).withColumn("published_at", F.lit("x"))
    top = funnel._top(rows, Thresholds(digest_size=2)).orderBy("rank").collect()
    assert [r.id for r in top] == ["m", "l"]


def test_message_and_document(world):
    news, prices, watch, stages = world
    counts = funnel.stage_counts(stages)
    digest = funnel.digest_of(stages, news)
    message = report.digest_messages(digest, counts).first().message
    sent, raw = counts.first().sent, counts.first().raw
    assert message.startswith("<b>IDX digest — 2026-09-14</b>\n\n<b>Q1</b> · <i>volume +")
    assert '<a href="http://n/h?p=1&amp;q=2">Q1 pauses &lt;deal&gt; talks &amp; buyers queue</a>\n\n' in message
    assert message.endswith(f"<i>{sent} of {raw} items ({1 - sent / raw:.1%} filtered)</i>\n{report.DISCLAIMER}")
    document = report.digest_documents(digest, counts).first().payload
    assert document.startswith('{"run_date":"2026-09-14","status":"success","trigger":null,"stages":{"raw":39,')
    empty = report.digest_messages(digest.where("false"), counts.withColumn("raw", F.lit(12345))).first().message
    assert empty == (
        "<b>IDX digest — 2026-09-14</b>\n\nNothing crossed threshold today.\n<i>Scanned 12,345 items.</i>\n" + report.DISCLAIMER
    )
    assert '"items":[]' in report.digest_documents(digest.where("false"), counts).first().payload


def test_zero_score_is_written_as_null(spark):
    counts = spark.createDataFrame([(date(2026, 9, 14), 1, 1, 1, 1, 1)], "run_date date, raw int, deduped int, surprising int, watchlist int, sent int")
    digest = spark.createDataFrame(
        [(date(2026, 9, 14), 1, "A", "t", "u", 0.0, 2.5, "price +2.5s")],
        "run_date date, rank int, symbol string, headline string, url string, volume_z double, return_z double, reason string",
    )
    assert '"volume_z":null,"return_z":2.5' in report.digest_documents(digest, counts).first().payload


def test_item_scores_number_clusters_from_zero(world):
    scores = funnel.item_scores(world[3]).collect()
    groups = {r.dedup_group for r in scores}
    assert groups == set(range(len(groups)))
    assert len(scores) == 39


def test_sweep_at_the_defaults_matches_the_funnel(world):
    news, prices, watch, stages = world
    row = evaluate.threshold_sweep(stages, [2.5], [2.0]).first()
    assert row.avg_digest_size == funnel.stage_counts(stages).first().sent


def test_failed_run_and_alert(spark):
    failures = spark.createDataFrame([(date(2026, 9, 14), "<" + "x" * 600)], "run_date date, error string")
    log = report.failed_run(failures, F.current_timestamp())
    row = log.first()
    assert (row.status, len(row.error), row.count_raw, row.started_at, row.trigger) == ("failed", 500, 0, None, "local")
    alert = report.failure_alerts(log).first().alert
    assert alert == "<b>⚠️ Pipeline failed — 2026-09-14</b>\n\n<code>&lt;" + "x" * 399 + "</code>"
