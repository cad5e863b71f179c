"""Thresholds of the funnel, as plain parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

# The default thresholds, limits and market hours.
DEDUP_SIMILARITY = 0.75
VOLUME_Z = 2.5
RETURN_Z = 2.0
BASELINE_WINDOW = 30
MIN_BASELINE_OBS = 10
DIGEST_SIZE = 10
LOOKBACK_DAYS = 7
BACKFILL_WINDOW_DAYS = 90
BACKFILL_COVERAGE = 0.6
# A watchlist up to this long is sent along with the query; a longer one is joined.
BROADCAST_WATCHLIST = 10_000
MARKET_ZONE = "Asia/Jakarta"
MARKET_CLOSE_HOUR = 17

# Exchange holidays of 2026.
HOLIDAYS = (
    "2026-01-01",
    "2026-03-19",
    "2026-03-20",
    "2026-03-23",
    "2026-05-01",
    "2026-05-14",
    "2026-06-01",
    "2026-08-17",
    "2026-12-25",
)

# The stocks a fresh installation starts with.
DEFAULT_WATCHLIST = (
    "BBCA", "BBRI", "BMRI", "BBNI", "TLKM", "ASII", "UNVR", "ICBP",
    "INDF", "KLBF", "GGRM", "HMSP", "ADRO", "PTBA", "ITMG", "UNTR",
    "ANTM", "INCO", "MDKA", "AMRT", "CPIN", "JPFA", "SMGR", "INTP",
    "PGAS", "EXCL", "ISAT", "TOWR", "MIKA", "GOTO", "BRPT", "TPIA",
    "MEDC", "AKRA", "BUKA", "ARTO", "BRIS", "MAPI", "ACES", "ERAA",
)


@dataclass(frozen=True)
class Thresholds:
    similarity: float = DEDUP_SIMILARITY
    volume_z: float = VOLUME_Z
    return_z: float = RETURN_Z
    window: int = BASELINE_WINDOW
    min_obs: int = MIN_BASELINE_OBS
    digest_size: int = DIGEST_SIZE
