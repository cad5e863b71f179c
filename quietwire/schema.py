"""Table schemas. Money is decimal, instants are UTC, symbols are upper case without a suffix."""

from pyspark.sql import types as T


def _table(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


DAILY_CLOSE = _table(
    ("symbol", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("close", T.DecimalType(20, 4), False),
    ("volume", T.LongType(), True),
    ("market_cap", T.DecimalType(24, 2), True),
    ("fetched_at", T.TimestampType(), True),
)

NEWS_ITEMS = _table(
    ("id", T.StringType(), False),
    ("symbol", T.StringType(), True),
    ("published_at", T.TimestampType(), False),
    ("title", T.StringType(), False),
    ("body", T.StringType(), True),
    ("source", T.StringType(), True),
    ("url", T.StringType(), True),
    ("fetched_at", T.TimestampType(), True),
)

BASELINES = _table(
    ("symbol", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("vol_mean_30d", T.DoubleType(), True),
    ("vol_std_30d", T.DoubleType(), True),
    ("ret_mean_30d", T.DoubleType(), True),
    ("ret_std_30d", T.DoubleType(), True),
    ("daily_return", T.DoubleType(), True),
)

ITEM_SCORES = _table(
    ("item_id", T.StringType(), False),
    ("run_date", T.DateType(), False),
    ("dedup_group", T.IntegerType(), True),
    ("volume_z", T.DoubleType(), True),
    ("return_z", T.DoubleType(), True),
    ("passed_stage", T.StringType(), False),
)

SENT_DIGESTS = _table(
    ("run_date", T.DateType(), False),
    ("sent_at", T.TimestampType(), True),
    ("item_count", T.IntegerType(), False),
)

# Messages and whether they are known to be out.
OUTBOX = _table(
    ("run_date", T.DateType(), False),
    ("kind", T.StringType(), False),
    ("message", T.StringType(), False),
    ("item_count", T.IntegerType(), True),
    ("created_at", T.TimestampType(), True),
    ("delivered_at", T.TimestampType(), True),
)

STAGES = ("raw", "deduped", "surprising", "watchlist", "sent")

RUN_LOG = _table(
    ("run_date", T.DateType(), False),
    ("trigger", T.StringType(), False),
    ("started_at", T.TimestampType(), True),
    ("finished_at", T.TimestampType(), True),
    ("status", T.StringType(), True),
    ("error", T.StringType(), True),
    *((f"count_{stage}", T.IntegerType(), True) for stage in STAGES),
)

WATCHLIST = _table(("symbol", T.StringType(), False), ("note", T.StringType(), True))
