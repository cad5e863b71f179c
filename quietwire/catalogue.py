"""Every operator as a query over the given tables, with the SQL that must give the same rows.

The tables hold no prices or news, so both are derived: prices from ``lineitem`` (a day of a
supplier group is a trading day of a symbol), news from ``documents``. Dates and instants are
shown as text and scores rounded, so that engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quietwire.operators.baselines import baselines, baselines_since
from quietwire.operators.coverage import backfill_gaps
from quietwire.operators.market_calendar import is_trading_day, last_closed_session
from quietwire.operators.near_duplicates import near_duplicate_followers, near_duplicates
from quietwire.operators.surprise import reason
from quietwire.operators.watchlist import mark_watched
from quietwire.plans import evaluate, funnel, report
from quietwire.schema import STAGES
from quietwire.session import configure
from quietwire.settings import HOLIDAYS, Thresholds
from quietwire.sources.landed import last_per_key, lookback, news_rows, price_rows
from quietwire.sources.tables import upsert

BACKFILL_START, BACKFILL_END = date(1996, 1, 1), date(1997, 6, 30)
SINCE = date(1997, 1, 1)
VOLUME_GRID, RETURN_GRID = (1.5, 2.0, 2.5, 3.0), (1.0, 2.0, 3.0)


# ---------------------------------------------------------------- derived inputs


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def daily_close(spark: SparkSession, folder: str, symbols: int | None = 4) -> DataFrame:
    """One row per symbol and day. Cents per unit are whole numbers, exact in every engine."""
    supplier = F.col("l_suppkey") if symbols is None else F.col("l_suppkey") % symbols
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).cast("double")
    quantity = F.sum("l_quantity")
    return (
        _table(spark, folder, "lineitem")
        .groupBy(F.concat(F.lit("S"), supplier).alias("symbol"), F.to_date("l_shipdate").alias("trade_date"))
        .agg(F.floor(cents / quantity).cast("decimal(20,4)").alias("close"), quantity.cast("bigint").alias("volume"))
    )


def _news_columns() -> list[Column]:
    day = F.date_add(F.lit("1998-01-05").cast("date"), (F.col("doc_id") % 20).cast("int"))
    symbol = F.when(F.col("lang") == "en", "S0").when(F.col("lang") == "de", "S1").when(F.col("lang") == "fr", "S2")
    return [
        F.col("doc_id").cast("string").alias("id"),
        symbol.otherwise("S3").alias("symbol"),
        F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400 + F.col("doc_id")).alias("published_at"),
        F.substring("text", 1, 140).alias("title"),
        F.col("text").alias("body"),
        F.concat(F.lit("https://news.example/"), F.col("source"), F.lit("/"), F.col("doc_id")).alias("url"),
    ]


def news_items(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select(*_news_columns())


def watchlist(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('S0'), ('s1'), ('S2') AS t(symbol)")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").withColumn("id", F.col("doc_id").cast("string"))


_PRICES_SQL = """
prices AS (
  SELECT concat('S', l_suppkey % 4) AS symbol, CAST(l_shipdate AS DATE) AS trade_date,
         CAST(FLOOR(CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / SUM(l_quantity)) AS DOUBLE) AS close,
         CAST(SUM(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2)"""
_WIDE_PRICES_SQL = _PRICES_SQL.replace("l_suppkey % 4", "l_suppkey")

_BASELINES_SQL = """
returns AS (
  SELECT *, close / NULLIF(LAG(close) OVER (PARTITION BY symbol ORDER BY trade_date), 0) - 1 AS daily_return
  FROM prices),
moments AS (
  SELECT *, AVG(volume) OVER w AS vol_mean_30d, STDDEV_SAMP(volume) OVER w AS vs, MIN(volume) OVER w AS v0,
         MAX(volume) OVER w AS v1, AVG(daily_return) OVER w AS ret_mean_30d, STDDEV_SAMP(daily_return) OVER w AS rs,
         MIN(daily_return) OVER w AS r0, MAX(daily_return) OVER w AS r1, COUNT(daily_return) OVER w AS n_obs
  FROM returns
  WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
baselines AS (
  SELECT *, CASE WHEN v0 = v1 AND vs IS NOT NULL THEN 0 ELSE vs END AS vol_std_30d,
         CASE WHEN r0 = r1 AND rs IS NOT NULL THEN 0 ELSE rs END AS ret_std_30d
  FROM moments),
cells AS (
  SELECT *, CASE WHEN n_obs >= 10 THEN (volume - vol_mean_30d) / NULLIF(vol_std_30d, 0) END AS volume_z,
         CASE WHEN n_obs >= 10 THEN (daily_return - ret_mean_30d) / NULLIF(ret_std_30d, 0) END AS return_z,
         LEAD(daily_return) OVER (PARTITION BY symbol ORDER BY trade_date) / NULLIF(ret_std_30d, 0) AS next_move
  FROM baselines)"""

_NEWS_SQL = """
news AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         CASE lang WHEN 'en' THEN 'S0' WHEN 'de' THEN 'S1' WHEN 'fr' THEN 'S2' ELSE 'S3' END AS symbol,
         CAST(DATE '1998-01-05' + CAST(doc_id % 20 AS INT) AS DATE) AS run_date,
         CAST(DATE '1998-01-05' + CAST(doc_id % 20 AS INT) AS TIMESTAMP) + doc_id * INTERVAL '1' SECOND AS published_at,
         substring(text, 1, 140) AS title, text AS body,
         concat('https://news.example/', source, '/', doc_id) AS url
  FROM documents)"""

_HOLIDAYS_SQL = ", ".join(f"DATE '{h}'" for h in HOLIDAYS)
_TRADING_SQL = f"isodow(run_date) < 6 AND run_date NOT IN ({_HOLIDAYS_SQL})"


def _dedup_sql(docs: str) -> str:
    """All-pairs similarity and the greedy walk. ``docs`` gives bucket, id, ord (a number), text."""
    return f"""
docs AS ({docs}),
words AS (SELECT bucket, id, ord, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM docs),
gram AS (
  SELECT bucket, id, ord, unnest(t) AS g FROM words UNION ALL
  SELECT bucket, id, ord, unnest([t[i] || ' ' || t[i + 1] for i in range(1, len(t))]) FROM words),
tf AS (SELECT bucket, id, ord, g, COUNT(*) AS tf FROM gram GROUP BY ALL),
df AS (SELECT bucket, g, COUNT(*) AS df FROM tf GROUP BY ALL),
sizes AS (SELECT bucket, COUNT(*) AS n FROM docs GROUP BY ALL),
raw_w AS (
  SELECT bucket, id, ord, g, df, tf * (ln((1 + n) / (1 + df)) + 1) AS w
  FROM tf JOIN df USING (bucket, g) JOIN sizes USING (bucket)),
norms AS (SELECT bucket, id, sqrt(SUM(w * w)) AS norm FROM raw_w GROUP BY ALL),
unit AS (SELECT bucket, id, ord, g, w / norm AS w FROM raw_w JOIN norms USING (bucket, id) WHERE df > 1),
similar_docs AS (
  SELECT a.bucket, a.id AS a, a.ord AS a_ord, b.id AS b, b.ord AS b_ord, SUM(a.w * b.w) AS similarity
  FROM unit a JOIN unit b ON a.bucket = b.bucket AND a.g = b.g AND a.ord < b.ord
  GROUP BY ALL HAVING SUM(a.w * b.w) >= 0.75),
later AS (SELECT bucket, b AS id, b_ord, list(a) AS near FROM similar_docs GROUP BY ALL),
touched AS (SELECT bucket, a AS id, a_ord AS ord FROM similar_docs UNION SELECT bucket, b, b_ord FROM similar_docs),
steps AS (
  SELECT t.bucket, t.id, coalesce(near, []) AS near, row_number() OVER (PARTITION BY t.bucket ORDER BY t.ord) AS step
  FROM touched t LEFT JOIN later l ON l.bucket = t.bucket AND l.id = t.id),
walk AS (
  SELECT bucket, id, step, [id] AS leaders, id AS leader_id FROM steps WHERE step = 1
  UNION ALL
  SELECT s.bucket, s.id, s.step,
         CASE WHEN len(list_intersect(leaders, near)) = 0 THEN list_append(leaders, s.id) ELSE leaders END,
         coalesce(([x for x in leaders if list_contains(near, x)])[1], s.id)
  FROM walk w JOIN steps s ON s.bucket = w.bucket AND s.step = w.step + 1),
led AS (SELECT d.bucket, d.id, coalesce(leader_id, d.id) AS leader_id FROM docs d LEFT JOIN walk w ON w.bucket = d.bucket AND w.id = d.id)"""


_LANG_DOCS_SQL = "SELECT lang AS bucket, CAST(doc_id AS VARCHAR) AS id, doc_id AS ord, text FROM documents"
_NEWS_DOCS_SQL = (
    "SELECT run_date || symbol AS bucket, id, row_number() OVER (ORDER BY published_at, id) AS ord, "
    f"title || ' ' || body AS text FROM news WHERE {_TRADING_SQL}"
)

_FUNNEL_SQL = f"""WITH RECURSIVE {_PRICES_SQL}, {_BASELINES_SQL}, {_NEWS_SQL}, {_dedup_sql(_NEWS_DOCS_SQL)},
flagged AS (
  SELECT n.id, n.symbol, n.run_date, n.published_at, n.title, n.url, leader_id, volume_z, return_z, next_move,
         n.id = leader_id AS deduped,
         n.id = leader_id AND (coalesce(abs(volume_z) >= 2.5, false) OR coalesce(abs(return_z) >= 2.0, false)) AS surprising,
         greatest(coalesce(abs(volume_z), 0), coalesce(abs(return_z), 0)) AS strength
  FROM news n JOIN led USING (id) LEFT JOIN cells c ON c.symbol = n.symbol AND c.trade_date = n.run_date),
watched AS (SELECT *, surprising AND symbol IN ('S0', 'S1', 'S2') AS watchlist FROM flagged),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run_date, watchlist ORDER BY strength DESC, published_at, id) AS rank FROM watched),
stages AS (SELECT *, watchlist AND rank <= 10 AS sent FROM ranked),
counts AS (
  SELECT run_date, COUNT(*) AS raw, COUNT_IF(deduped) AS deduped, COUNT_IF(surprising) AS surprising,
         COUNT_IF(watchlist) AS watchlist, COUNT_IF(sent) AS sent
  FROM stages GROUP BY run_date),
shown AS (
  SELECT *, coalesce(nullif(concat_ws(', ',
      CASE WHEN abs(volume_z) >= 2.5 THEN 'volume ' || printf('%+.1f', volume_z) || 's' END,
      CASE WHEN abs(return_z) >= 2.0 THEN 'price ' || printf('%+.1f', return_z) || 's' END), ''), 'watchlist') AS reason
  FROM stages)
"""

_REASON_SQL = """coalesce(nullif(concat_ws(', ',
      CASE WHEN abs(volume_z) >= 2.5 THEN 'volume ' || printf('%+.1f', volume_z) || 's' END,
      CASE WHEN abs(return_z) >= 2.0 THEN 'price ' || printf('%+.1f', return_z) || 's' END), ''), 'watchlist')"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(run):
        name = run.__name__
        QUERIES[name] = lambda spark, folder: _comparable(run(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _comparable(df: DataFrame) -> DataFrame:
    """Dates and instants as text, decimals as doubles."""
    kinds = {"date": "string", "timestamp": "string", "timestamp_ntz": "string"}
    return df.select(
        *(
            F.col(name).cast("double" if kind.startswith("decimal") else kinds[kind]).alias(name)
            if kind in kinds or kind.startswith("decimal")
            else F.col(name)
            for name, kind in df.dtypes
        )
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


_MOMENTS = ("daily_return", "vol_mean_30d", "vol_std_30d", "ret_mean_30d", "ret_std_30d")
_MOMENTS_SQL = ", ".join(f"round({m}, 6) AS {m}" for m in _MOMENTS)
_Z_SQL = "round(volume_z, 6) AS volume_z, round(return_z, 6) AS return_z"


def _text(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


# ---------------------------------------------------------------- baselines and scores


@_query(
    f"WITH {_WIDE_PRICES_SQL}, {_BASELINES_SQL} SELECT symbol, {_text('trade_date')}, close, volume, {_MOMENTS_SQL}, n_obs FROM baselines"
)
def baseline_rolling(spark, folder):
    return _rounded(baselines(daily_close(spark, folder, None)), *_MOMENTS)


@_query(
    f"WITH {_WIDE_PRICES_SQL}, {_BASELINES_SQL} SELECT symbol, {_text('trade_date')}, close, volume, {_MOMENTS_SQL}, n_obs "
    f"FROM baselines WHERE trade_date >= DATE '{SINCE}'"
)
def baseline_incremental(spark, folder):
    return _rounded(baselines_since(daily_close(spark, folder, None), SINCE), *_MOMENTS)


def _scored_news(spark, folder):
    cells = funnel.scored_cells(daily_close(spark, folder), watchlist(spark))
    return funnel.score_news(funnel.daily_news(news_items(spark, folder), None), cells)


@_query(
    f"WITH {_PRICES_SQL}, {_BASELINES_SQL}, {_NEWS_SQL} SELECT n.id, n.symbol, CAST(n.run_date AS VARCHAR) AS run_date, {_Z_SQL} "
    "FROM news n LEFT JOIN cells c ON c.symbol = n.symbol AND c.trade_date = n.run_date"
)
def surprise_scores(spark, folder):
    return _rounded(
        _scored_news(spark, folder).select("id", "symbol", "run_date", "volume_z", "return_z"), "volume_z", "return_z"
    )


@_query(
    f"""WITH {_WIDE_PRICES_SQL}, {_BASELINES_SQL} SELECT symbol, CAST(trade_date AS VARCHAR) AS run_date,
    round((volume - vol_mean_30d) / NULLIF(vol_std_30d, 0), 6) AS volume_z,
    round((daily_return - ret_mean_30d) / NULLIF(ret_std_30d, 0), 6) AS return_z FROM baselines"""
)
def surprise_live(spark, folder):
    """Scores without a least number of observations, as a live run gives them."""
    limits = Thresholds(min_obs=0)
    cells = funnel.scored_cells(daily_close(spark, folder, None), watchlist(spark), limits)
    return _rounded(cells.select("symbol", "run_date", "volume_z", "return_z"), "volume_z", "return_z")


@_query(
    f"""WITH {_NEWS_SQL}, linked AS (SELECT id, CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'javascript:' || url
    WHEN CAST(id AS BIGINT) % 7 = 0 THEN replace(url, 'https', 'http') WHEN CAST(id AS BIGINT) % 11 = 0 THEN NULL ELSE url END AS url FROM news)
    SELECT id, coalesce(regexp_matches(url, '^https?://'), false) AS is_link FROM linked"""
)
def link_schemes(spark, folder):
    number, url = F.col("id").cast("bigint"), F.col("url")
    changed = (
        F.when(number % 5 == 0, F.concat(F.lit("javascript:"), url))
        .when(number % 7 == 0, F.replace(url, F.lit("https"), F.lit("http")))
        .when(number % 11 == 0, F.lit(None))
        .otherwise(url)
    )
    return news_items(spark, folder).select("id", report.is_link(changed).alias("is_link"))


@_query(
    f"WITH {_PRICES_SQL}, {_BASELINES_SQL}, {_NEWS_SQL} SELECT n.id, n.symbol, {_REASON_SQL} AS reason "
    "FROM news n JOIN cells c ON c.symbol = n.symbol AND c.trade_date = n.run_date "
    "WHERE abs(volume_z) >= 2.5 OR abs(return_z) >= 2.0"
)
def surprising_items(spark, folder):
    return _scored_news(spark, folder).where("surprising").select("id", "symbol", reason().alias("reason"))


@_query(f"WITH {_NEWS_SQL} SELECT id, symbol FROM news WHERE symbol IN ('S0', 'S1', 'S2')")
def watchlist_semi(spark, folder):
    return mark_watched(news_items(spark, folder).select("id", "symbol"), watchlist(spark)).where("watched").drop("watched")


@_query(f"WITH {_NEWS_SQL} SELECT id, symbol FROM news")
def watchlist_empty(spark, folder):
    nothing = watchlist(spark).where("symbol IS NULL")
    return mark_watched(news_items(spark, folder).select("id", "symbol"), nothing).where("watched").drop("watched")


# ---------------------------------------------------------------- near duplicates


def _by_language(find):
    def run(spark, folder):
        return find(_documents(spark, folder), bucket=["lang"], order=["doc_id"], text=F.col("text"))

    return run


@_query(f"WITH RECURSIVE {_dedup_sql(_LANG_DOCS_SQL)} SELECT bucket AS lang, id, leader_id FROM led")
def dedup_groups(spark, folder):
    return _by_language(near_duplicates)(spark, folder)


@_query(f"WITH RECURSIVE {_dedup_sql(_LANG_DOCS_SQL)} SELECT bucket AS lang, id FROM led WHERE id = leader_id")
def dedup_kept(spark, folder):
    return dedup_groups(spark, folder).where("id = leader_id").drop("leader_id")


@_query(
    f"""WITH RECURSIVE {_dedup_sql(_LANG_DOCS_SQL)}
    SELECT l.bucket AS lang, l.id AS member, leader_id AS leader, round(s.similarity, 6) AS similarity
    FROM led l JOIN similar_docs s ON s.bucket = l.bucket AND s.a = leader_id AND s.b = l.id WHERE l.id <> leader_id"""
)
def dedup_edges(spark, folder):
    return _rounded(_by_language(near_duplicate_followers)(spark, folder), "similarity")


# ---------------------------------------------------------------- funnel and digest


def _inputs(spark, folder):
    return news_items(spark, folder), daily_close(spark, folder), watchlist(spark)


def _stages(spark, folder):
    return funnel.item_stages(*_inputs(spark, folder))


def _counts(spark, folder):
    return funnel.stage_counts(_stages(spark, folder))


@_query(
    f"{_FUNNEL_SQL} SELECT {_text('run_date')}, rank, id, symbol, title AS headline, url, {_Z_SQL}, reason FROM shown WHERE sent"
)
def digest_topk(spark, folder):
    return _rounded(funnel.digest(*_inputs(spark, folder)), "volume_z", "return_z")


# A second world of twenty symbols, all of them watched, with a few items per symbol and day.
_WIDE_SYMBOLS = 20
_WIDE_FUNNEL_SQL = (
    _FUNNEL_SQL.replace("l_suppkey % 4", f"l_suppkey % {_WIDE_SYMBOLS}")
    .replace("CASE lang WHEN 'en' THEN 'S0' WHEN 'de' THEN 'S1' WHEN 'fr' THEN 'S2' ELSE 'S3' END", f"concat('S', doc_id // 20 % {_WIDE_SYMBOLS})")
    .replace("symbol IN ('S0', 'S1', 'S2')", "true")
)


def _wide_digest(spark, folder):
    news = _table(spark, folder, "documents").select(*_news_columns())
    symbol = F.concat(F.lit("S"), F.floor(F.col("id").cast("bigint") / 20) % _WIDE_SYMBOLS)
    nothing = watchlist(spark).where("symbol IS NULL")
    return funnel.digest(news.withColumn("symbol", symbol), daily_close(spark, folder, _WIDE_SYMBOLS), nothing)


@_query(
    f"{_WIDE_FUNNEL_SQL} SELECT {_text('run_date')}, rank, id, symbol, title AS headline, url, {_Z_SQL}, reason FROM shown WHERE sent"
)
def digest_wide(spark, folder):
    return _rounded(_wide_digest(spark, folder), "volume_z", "return_z")


@_query(
    f"""{_WIDE_FUNNEL_SQL} SELECT {_text('run_date')}, symbol, MIN(rank) AS first_rank, COUNT(*) AS headlines,
    string_agg(title, ' | ' ORDER BY rank) AS titles, round(arg_min(volume_z, rank), 6) AS volume_z,
    round(arg_min(return_z, rank), 6) AS return_z FROM shown WHERE sent GROUP BY run_date, symbol"""
)
def digest_wide_by_symbol(spark, folder):
    grouped = report.digest_by_symbol(_wide_digest(spark, folder))
    return _rounded(grouped.withColumn("titles", F.array_join("titles", " | ")), "volume_z", "return_z")


@_query(f"WITH {_NEWS_SQL} SELECT {_text('run_date')}, COUNT(*) AS items FROM news WHERE NOT ({_TRADING_SQL}) GROUP BY run_date")
def left_out_days(spark, folder):
    return funnel.left_out(news_items(spark, folder))


@_query(f"{_FUNNEL_SQL} SELECT {_text('run_date')}, raw, deduped, surprising, watchlist, sent FROM counts")
def stage_counts(spark, folder):
    return _counts(spark, folder)


@_query(f"{_FUNNEL_SQL} SELECT {_text('run_date')}, raw, sent, 1 - sent / raw AS compression FROM counts")
def compression(spark, folder):
    ratio = funnel.compression(F.col("sent"), F.col("raw"))
    return _counts(spark, folder).select("run_date", "raw", "sent", ratio.alias("compression"))


@_query(
    f"""{_FUNNEL_SQL} SELECT s.id AS item_id, {_text('run_date')},
    CAST(dense AS INT) AS dedup_group, {_Z_SQL}, CASE WHEN sent THEN 'sent' WHEN watchlist THEN 'watchlist'
    WHEN surprising THEN 'surprising' WHEN deduped THEN 'deduped' ELSE 'raw' END AS passed_stage
    FROM stages s JOIN (SELECT id AS lead_id, row_number() OVER (PARTITION BY run_date ORDER BY symbol, published_at, id) - 1 AS dense
    FROM stages WHERE deduped) d ON d.lead_id = s.leader_id"""
)
def item_scores(spark, folder):
    return _rounded(funnel.item_scores(_stages(spark, folder)), "volume_z", "return_z")


_JSON_SQL = """concat('{"symbol":', to_json(symbol), ',"headline":', to_json(title), ',"url":', to_json(url),
  ',"volume_z":', coalesce(CASE WHEN volume_z <> 0 THEN CAST(round(volume_z, 2) AS VARCHAR) END, 'null'),
  ',"return_z":', coalesce(CASE WHEN return_z <> 0 THEN CAST(round(return_z, 2) AS VARCHAR) END, 'null'), ',"reason":', to_json(reason), '}')"""


@_query(
    f"""{_FUNNEL_SQL}, entries AS (SELECT run_date, string_agg({_JSON_SQL}, ',' ORDER BY rank) AS items FROM shown WHERE sent GROUP BY run_date)
    SELECT {_text('run_date')}, concat('{{"run_date":"', run_date, '","status":"success","trigger":"schedule","stages":{{"raw":', raw,
    ',"deduped":', deduped, ',"surprising":', surprising, ',"watchlist":', watchlist, ',"sent":', sent, '}},"items":[',
    coalesce(items, ''), ']}}') AS payload FROM counts LEFT JOIN entries USING (run_date)"""
)
def digest_json(spark, folder):
    stages = _stages(spark, folder)
    digest = funnel.digest_of(stages, news_items(spark, folder))
    return report.digest_documents(digest, funnel.stage_counts(stages), "schedule")


def _escaped_sql(column: str) -> str:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        column = f"replace({column}, '{raw}', '{safe}')"
    return column


@_query(
    f"""{_FUNNEL_SQL}, entries AS (SELECT run_date, COUNT(*) AS n, string_agg(concat('<b>', symbol, '</b> · <i>', {_escaped_sql('reason')},
    '</i>', chr(10), '<a href="', {_escaped_sql('url')}, '">', {_escaped_sql('substring(title, 1, 140)')}, '</a>', chr(10), chr(10)), '' ORDER BY rank) AS body
    FROM shown WHERE sent GROUP BY run_date)
    SELECT {_text('run_date')}, concat('<b>{report.MESSAGE_TITLE} — ', run_date, '</b>', chr(10), chr(10),
    CASE WHEN n > 0 THEN concat(body, '<i>', n, ' of ', format('{{:,}}', raw), ' items (', printf('%.1f', 100 * (1 - n / raw)), '% filtered)</i>', chr(10))
    ELSE concat('Nothing crossed threshold today.', chr(10), '<i>Scanned ', format('{{:,}}', raw), ' items.</i>', chr(10)) END,
    '{report.DISCLAIMER}') AS message FROM counts LEFT JOIN entries USING (run_date)"""
)
def digest_message(spark, folder):
    stages = _stages(spark, folder)
    return report.digest_messages(funnel.digest_of(stages, news_items(spark, folder)), funnel.stage_counts(stages))


@_query(
    f"""{_FUNNEL_SQL} SELECT {_text('run_date')}, symbol, MIN(rank) AS first_rank, COUNT(*) AS headlines,
    string_agg(title, ' | ' ORDER BY rank) AS titles, round(arg_min(volume_z, rank), 6) AS volume_z,
    round(arg_min(return_z, rank), 6) AS return_z FROM shown WHERE sent GROUP BY run_date, symbol"""
)
def digest_by_symbol(spark, folder):
    grouped = report.digest_by_symbol(funnel.digest(*_inputs(spark, folder)))
    return _rounded(grouped.withColumn("titles", F.array_join("titles", " | ")), "volume_z", "return_z")


@_query(
    f"""{_FUNNEL_SQL}, bars AS (SELECT run_date, greatest(raw, deduped, surprising, watchlist, sent, 1) AS m, unnest([
    {', '.join(f"{{'position': {i}, 'stage': '{s}', 'label': '{report.STAGE_LABELS[s]}', 'items': {s}}}" for i, s in enumerate(STAGES))}]) AS b FROM counts)
    SELECT {_text('run_date')}, b.position AS position, b.stage AS stage, b.label AS label, b.items AS items,
    round(greatest(100 * ln(b.items + 1) / ln(m + 1), 2.0), 6) AS width FROM bars"""
)
def stage_bars(spark, folder):
    return _rounded(report.stage_bars(_counts(spark, folder)), "width")


@_query(
    f"""{_FUNNEL_SQL}, days AS (SELECT DISTINCT run_date FROM news)
    SELECT {_text('run_date')}, 'schedule' AS trigger, CASE WHEN {_TRADING_SQL} THEN 'success' ELSE 'no_trading_day' END AS status,
    {', '.join(f'CAST(coalesce({s}, 0) AS INT) AS count_{s}' for s in STAGES)} FROM days LEFT JOIN counts USING (run_date)"""
)
def run_log(spark, folder):
    days = funnel.daily_news(news_items(spark, folder), None).select("run_date").distinct()
    counts = days.join(_counts(spark, folder), "run_date", "left")
    now = F.current_timestamp()
    log = report.run_log(counts, is_trading_day(F.col("run_date")), now, now, "schedule")
    return log.drop("started_at", "finished_at", "error")


@_query(f"{_FUNNEL_SQL} SELECT {_text('run_date')}, CAST(sent AS INT) AS item_count FROM counts WHERE day(run_date) % 2 = 1")
def unsent_runs(spark, folder):
    counts = _counts(spark, folder)
    ledger = report.mark_sent(counts.where(F.dayofmonth("run_date") % 2 == 0), F.current_timestamp())
    return report.mark_sent(report.unsent(counts, ledger), F.current_timestamp()).drop("sent_at")


# ---------------------------------------------------------------- evaluation


@_query(
    f"WITH {_WIDE_PRICES_SQL}, {_BASELINES_SQL} SELECT symbol, CAST(trade_date AS VARCHAR) AS run_date, round(next_move, 6) AS next_move, "
    "abs(next_move) >= 3 AS material, abs(next_move) <= 0.2 AS immaterial FROM cells"
)
def next_day_label(spark, folder):
    return _rounded(evaluate.labelled_days(daily_close(spark, folder, None)), "next_move")


@_query(
    f"""{_FUNNEL_SQL} SELECT COUNT(*) AS suppressed, COUNT_IF(abs(next_move) >= 3) AS missed,
    COUNT_IF(abs(next_move) >= 3) / COUNT(*) AS miss_rate FROM stages WHERE NOT sent AND next_move IS NOT NULL"""
)
def miss_rate(spark, folder):
    return evaluate.miss_rate(_stages(spark, folder))


@_query(
    f"""{_FUNNEL_SQL}, grid AS (SELECT * FROM (SELECT unnest({list(VOLUME_GRID)})::DOUBLE AS vol_t), (SELECT unnest({list(RETURN_GRID)})::DOUBLE AS ret_t)),
    hits AS (SELECT vol_t, ret_t, run_date, deduped, coalesce(abs(next_move) >= 3, false) AS material,
      (coalesce(abs(volume_z) >= vol_t, false) OR coalesce(abs(return_z) >= ret_t, false)) AND symbol IN ('S0', 'S1', 'S2') AS passes
      FROM stages, grid),
    daily AS (SELECT vol_t, ret_t, run_date, COUNT_IF(deduped AND passes) AS passing, COUNT_IF(deduped AND material AND NOT passes) AS missed
      FROM hits GROUP BY ALL)
    SELECT vol_t, ret_t, AVG(least(passing, 10)) AS avg_digest_size, CAST(SUM(missed) AS BIGINT) AS misses FROM daily GROUP BY ALL"""
)
def threshold_sweep(spark, folder):
    return evaluate.threshold_sweep(_stages(spark, folder), VOLUME_GRID, RETURN_GRID)


# ---------------------------------------------------------------- landed records


@_query(
    f"""WITH {_WIDE_PRICES_SQL} SELECT symbol, {_text('trade_date')}, close + CASE WHEN day(trade_date) <= 3 THEN 1 ELSE 0 END AS close,
    CASE WHEN day(trade_date) <> 5 THEN volume END AS volume, CAST(NULL AS DOUBLE) AS market_cap
    FROM prices WHERE day(trade_date) <> 13"""
)
def ingest_prices(spark, folder):
    return price_rows(_landed_prices(spark, folder)).rows


@_query(f"WITH {_WIDE_PRICES_SQL} SELECT COUNT(*) AS rejected FROM prices WHERE day(trade_date) = 13")
def ingest_quarantine(spark, folder):
    return price_rows(_landed_prices(spark, folder)).quarantine.agg(F.count(F.lit(1)).alias("rejected"))


def _landed_prices(spark, folder):
    """A payload per symbol and month, bare or in an envelope, and a corrected one for its first days."""
    day = F.dayofmonth("trade_date")

    def payload(close: Column) -> Column:
        row = F.struct(
            F.concat(F.lit(" "), F.lower("symbol"), F.lit(".jk")).alias("symbol"),
            F.col("trade_date").cast("string").alias("date"),
            F.when(day == 13, "-").otherwise(close.cast("string")).alias("close"),
            F.when(day == 5, "").otherwise(F.col("volume").cast("string")).alias("volume"),
        )
        listed = F.to_json(F.collect_list(row))
        return F.when(F.col("month") % 2 == 0, listed).otherwise(F.concat(F.lit('{"results":'), listed, F.lit("}")))

    prices = daily_close(spark, folder, None).withColumn("month", F.year("trade_date") * 12 + F.month("trade_date"))
    first = prices.groupBy("symbol", "month").agg(payload(F.col("close")).alias("payload"))
    fixed = prices.where(day <= 3).groupBy("symbol", "month").agg(payload(F.col("close") + 1).alias("payload"))
    late = fixed.withColumn("month", F.col("month") + 100_000)
    return first.union(late).select("symbol", F.col("month").alias("ordinal"), "payload")


_MALFORMED_SQL = f"""WITH {_WIDE_PRICES_SQL},
landed AS (
  SELECT *, year(trade_date) * 12 + month(trade_date) AS m, day(trade_date) AS d FROM prices),
placed AS (
  SELECT *, symbol || '/' || m AS ordinal,
         CAST(row_number() OVER (PARTITION BY symbol, m ORDER BY trade_date) - CASE WHEN m % 5 = 2 THEN 0 ELSE 1 END AS INT) AS position
  FROM landed),
pages AS (SELECT DISTINCT ordinal, m FROM placed)
"""


@_query(
    f"""{_MALFORMED_SQL} SELECT 'row' AS kind, symbol, {_text('trade_date')}, close,
    CASE WHEN d = 7 THEN NULL WHEN d = 5 THEN volume + 1 ELSE volume END AS volume,
    CAST(NULL AS VARCHAR) AS ordinal, CAST(NULL AS INT) AS position, CAST(NULL AS VARCHAR) AS reason
    FROM placed WHERE m % 11 <> 0 AND d <> 13
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, ordinal, position, 'no close' FROM placed WHERE m % 11 <> 0 AND d = 13
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, ordinal, 0, 'no record' FROM pages WHERE m % 11 <> 0 AND m % 5 = 2
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, ordinal, NULL, 'no list' FROM pages WHERE m % 11 = 0
    UNION ALL SELECT 'note', NULL, NULL, NULL, NULL, ordinal, position, 'volume out of range' FROM placed WHERE m % 11 <> 0 AND d = 7"""
)
def ingest_malformed(spark, folder):
    """Truncated pages, elements that are no records, byte order marks, numbers that do not fit, fractions."""
    cleaned = price_rows(_malformed_prices(spark, folder))
    rows = cleaned.rows.select(F.lit("row").alias("kind"), "symbol", "trade_date", "close", "volume")
    for kind, left_out in (("quarantine", cleaned.quarantine), ("note", cleaned.notes)):
        rows = rows.unionByName(left_out.select(F.lit(kind).alias("kind"), "ordinal", "position", "reason"), allowMissingColumns=True)
    return rows


def _malformed_prices(spark, folder):
    prices = daily_close(spark, folder, None).withColumn("m", F.year("trade_date") * 12 + F.month("trade_date"))
    day, month = F.dayofmonth("trade_date"), F.col("m")
    record = F.struct(
        F.col("trade_date").cast("string").alias("date"),
        F.when(day == 13, "1e30").otherwise(F.col("close").cast("string")).alias("close"),
        F.when(day == 7, F.lit(1e30)).when(day == 5, F.col("volume") + 0.75).otherwise(F.col("volume").cast("double")).alias("volume"),
    )
    listed = F.to_json(F.sort_array(F.collect_list(record)))
    page = F.when(month % 5 == 2, F.concat(F.lit("[5,"), F.substr(listed, F.lit(2)))).otherwise(listed)
    page = F.when(month % 11 == 0, F.substr(page, F.lit(1), F.length(page) - 3)).otherwise(page)
    page = F.when(month % 3 == 1, F.concat(F.lit("\ufeff"), page)).otherwise(page)
    pages = prices.groupBy("symbol", "m").agg(page.alias("payload"))
    return pages.select("symbol", F.concat_ws("/", "symbol", "m").alias("ordinal"), "payload")


@_query(
    f"WITH {_WIDE_PRICES_SQL} SELECT 'T' || symbol AS symbol, {_text('trade_date')}, close, volume, CAST(NULL AS DOUBLE) AS market_cap FROM prices"
)
def ingest_ticker(spark, folder):
    """Records under ``data`` that name their symbol as ``ticker``."""
    ticker = F.concat(F.lit("t"), F.lower("symbol"), F.lit(".JK")).alias("ticker")
    record = F.struct(ticker, F.col("trade_date").cast("string").alias("date"), F.col("close").cast("string").alias("close"), "volume")
    prices = daily_close(spark, folder, None)
    pages = prices.groupBy("symbol", F.year("trade_date").alias("ordinal")).agg(F.to_json(F.collect_list(record)).alias("listed"))
    landing = pages.select("symbol", "ordinal", F.concat(F.lit('{"data":'), "listed", F.lit("}")).alias("payload"))
    return price_rows(landing).rows


@_query(
    f"""WITH {_NEWS_SQL}, landed AS (SELECT *, '  ' || title || ' ' AS raw_title FROM news WHERE CAST(id AS BIGINT) % 10 <> 3)
    SELECT sha1(concat(raw_title, '|', url, '|')) AS id,
    CASE WHEN CAST(id AS BIGINT) % 17 = 0 THEN NULL WHEN CAST(id AS BIGINT) % 2 = 0 AND symbol = 'S3' THEN 'ZZ' ELSE symbol END AS symbol,
    strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, regexp_replace(raw_title, '^\\s+|\\s+$', '', 'g') AS title,
    CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN 'updated' ELSE body END AS body, url AS source, url FROM landed"""
)
def ingest_news(spark, folder):
    listed = watchlist(spark).select(F.upper("symbol").alias("symbol"))
    return news_rows(_landed_news(spark, folder), listed).rows


def _landed_news(spark, folder):
    """Pages of fifty articles in an envelope; some are listed again, later and changed."""
    number = F.col("id").cast("bigint")
    own = F.concat("symbol", F.lit(".JK"))
    symbols = (
        F.when(number % 17 == 0, F.array().cast("array<string>"))
        .when(number % 2 == 0, F.array(F.lit("zz.jk"), F.lit(""), own))
        .otherwise(F.array(own))
    )

    def page(body: Column) -> Column:
        article = F.struct(
            F.when(number % 10 == 3, "  ").otherwise(F.concat(F.lit("  "), F.col("title"), F.lit(" "))).alias("title"),
            body.alias("body"),
            F.col("url").alias("source"),
            F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            symbols.alias("symbols"),
        )
        return F.to_json(F.struct(F.collect_list(article).alias("results"), F.struct(F.lit(True).alias("has_next")).alias("pagination")))

    news = news_items(spark, folder).withColumn("page", F.floor(number / 50))
    first = news.groupBy("page").agg(page(F.col("body")).alias("payload"))
    again = news.where(number % 7 == 0).groupBy((F.col("page") + 1_000_000_000).alias("page"))
    return first.union(again.agg(page(F.lit("updated")).alias("payload"))).withColumnRenamed("page", "ordinal")


@_query(
    f"WITH {_WIDE_PRICES_SQL} SELECT symbol, {_text('trade_date')}, close, volume FROM prices "
    f"WHERE trade_date BETWEEN DATE '{SINCE}' - 7 AND DATE '{SINCE}'"
)
def price_lookback(spark, folder):
    return lookback(daily_close(spark, folder, None), SINCE)


@_query(
    "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id"
)
def last_row_per_key(spark, folder):
    events = _table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return last_per_key(events, ["user_id"], ["ts"]).drop("ts")


# ---------------------------------------------------------------- tables

_UPSERT_SQL = f"""WITH {_WIDE_PRICES_SQL},
stored AS (SELECT *, 'old' AS note FROM prices WHERE trade_date < DATE '{SINCE}'),
fresh AS (SELECT symbol, trade_date, close + 1 AS close FROM prices WHERE trade_date >= DATE '{SINCE}' - 90)"""


def _write_pair(spark, folder):
    prices = daily_close(spark, folder, None)
    stored = prices.where(F.col("trade_date") < F.lit(SINCE)).withColumn("note", F.lit("old"))
    fresh = prices.where(F.col("trade_date") >= F.date_sub(F.lit(SINCE), 90))
    return stored, fresh.select("symbol", "trade_date", (F.col("close") + 1).cast("decimal(20,4)").alias("close"))


@_query(
    f"""{_UPSERT_SQL} SELECT symbol, {_text('trade_date')}, coalesce(f.close, s.close) AS close, volume, note
    FROM stored s FULL JOIN fresh f USING (symbol, trade_date)"""
)
def upsert_update(spark, folder):
    return upsert(*_write_pair(spark, folder), ["symbol", "trade_date"])


@_query(
    f"""{_UPSERT_SQL} SELECT symbol, {_text('trade_date')}, coalesce(s.close, f.close) AS close, volume, note
    FROM stored s FULL JOIN fresh f USING (symbol, trade_date)"""
)
def upsert_insert_only(spark, folder):
    return upsert(*_write_pair(spark, folder), ["symbol", "trade_date"], insert_only=True)


_RUNS_SQL = """runs AS (SELECT CAST(o_orderdate AS DATE) AS run_date, COUNT(*) AS raw FROM orders GROUP BY 1)"""


def _runs(spark, folder):
    orders = _table(spark, folder, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("run_date")).agg(F.count(F.lit(1)).alias("raw"))


@_query(
    f"""WITH {_RUNS_SQL} SELECT {_text('run_date')}, CASE WHEN day(run_date) > 15 THEN 'schedule' ELSE 'local' END AS trigger,
    CAST(raw AS INT) AS count_raw, CAST(0 AS INT) AS count_watchlist FROM runs"""
)
def runlog_rekey(spark, folder):
    trigger = F.when(F.dayofmonth("run_date") > 15, "schedule")
    old = _runs(spark, folder).select("run_date", trigger.alias("trigger"), F.col("raw").cast("int").alias("count_raw"))
    return report.rekey_run_log(old)


@_query(
    f"""WITH {_RUNS_SQL}, newest AS (SELECT * FROM runs ORDER BY run_date DESC LIMIT 30)
    SELECT {_text('run_date')}, 'local' AS trigger, raw, strftime(CAST(run_date AS TIMESTAMP) + INTERVAL 12 HOUR + INTERVAL 7 HOUR, '%-d %b %Y, %H:%M') || ' WIB' AS finished
    FROM newest"""
)
def recent_runs(spark, folder):
    log = _runs(spark, folder).withColumn("trigger", F.lit("local"))
    noon = F.timestamp_seconds(F.unix_date("run_date").cast("bigint") * 86400 + 43200)
    return report.recent_runs(log).withColumn("finished", report.local_time(noon))


@_query(
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date, concat('<b>⚠️ Pipeline failed — ', CAST(ts AS DATE), '</b>', chr(10), chr(10),
    '<code>', {_escaped_sql("substring(concat('event ', event_id, ' <', props, '>'), 1, 400)")}, '</code>') AS alert
    FROM events WHERE event_type = 'error'"""
)
def failure_alerts(spark, folder):
    events = _table(spark, folder, "events").where(F.col("event_type") == "error")
    error = F.concat(F.lit("event "), F.col("event_id"), F.lit(" <"), F.col("props"), F.lit(">"))
    failures = events.select(F.to_date("ts").alias("run_date"), error.alias("error"))
    return report.failure_alerts(report.failed_run(failures, F.current_timestamp()))


# ---------------------------------------------------------------- calendar and history load

_LOCAL = "ts + INTERVAL 731 DAY + INTERVAL 7 HOUR"


@_query(
    f"""WITH local AS (SELECT event_id, CAST({_LOCAL} AS DATE) - CASE WHEN hour({_LOCAL}) < 17 THEN 1 ELSE 0 END AS d FROM events),
    back AS (SELECT event_id, d, [CAST(d - CAST(i AS INT) AS DATE) for i in range(0, 10)] AS days FROM local)
    SELECT event_id, isodow(d) < 6 AND CAST(d AS DATE) NOT IN ({_HOLIDAYS_SQL}) AS trading,
    CAST(([x for x in days if isodow(x) < 6 AND x NOT IN ({_HOLIDAYS_SQL})])[1] AS VARCHAR) AS session FROM back"""
)
def trading_calendar(spark, folder):
    """Event times moved to 2026, the year of the known holidays."""
    instant = F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(731))
    local = F.from_utc_timestamp(instant, "Asia/Jakarta")
    day = F.date_sub(F.to_date(local), (F.hour(local) < 17).cast("int"))
    return _table(spark, folder, "events").select(
        "event_id", is_trading_day(day).alias("trading"), last_closed_session(instant).alias("session")
    )


@_query(
    f"""WITH {_WIDE_PRICES_SQL}, starts AS (SELECT unnest(generate_series(DATE '{BACKFILL_START}', DATE '{BACKFILL_END}' - 1, INTERVAL 90 DAY))::DATE AS w_start),
    windows AS (SELECT symbol, w_start, least(w_start + 89, DATE '{BACKFILL_END}') AS w_end FROM (SELECT DISTINCT symbol FROM prices), starts),
    found AS (SELECT w.symbol, w_start, w_end, COUNT(p.trade_date) AS covered FROM windows w
      LEFT JOIN prices p ON p.symbol = w.symbol AND p.trade_date BETWEEN w_start AND w_end GROUP BY ALL)
    SELECT symbol, {_text('w_start', 'w_end')}, covered, CAST(w_end - w_start + 1 AS INT) AS span,
    covered < (w_end - w_start + 1) * 0.6 AS needs_fetch FROM found"""
)
def backfill_report(spark, folder):
    prices = daily_close(spark, folder, None)
    return backfill_gaps(prices, prices, BACKFILL_START, BACKFILL_END)
