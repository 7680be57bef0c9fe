"""Column names of the daily, weekly and monthly tables behind one vocabulary."""

from __future__ import annotations

SUFFIX = {"daily": "day", "weekly": "week", "monthly": "month"}


def columns(timeframe: str) -> dict[str, str]:
    """Map ``return, volatility, volume, open, close, high, low`` to the table's columns."""
    if timeframe not in SUFFIX:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    suffix = SUFFIX[timeframe]
    tail = "" if timeframe == "daily" else f"_{suffix}"
    out = {"return": f"return_pct_{suffix}", "volatility": f"volatility_{suffix}",
           "volume": f"volume_sum_{suffix}"}
    out.update({side: f"{side}_price{tail}" for side in ("open", "close", "high", "low")})
    return out
