from storecast.functions.dates import calendar_days, parse_day_first, parse_iso, repair_date
from storecast.functions.numeric import (
    clip_low,
    pct_change,
    portable_hash,
    round_half_even,
    round_to_multiple,
    share_pct,
)

__all__ = [
    "calendar_days",
    "clip_low",
    "parse_day_first",
    "parse_iso",
    "pct_change",
    "portable_hash",
    "repair_date",
    "round_half_even",
    "round_to_multiple",
    "share_pct",
]
