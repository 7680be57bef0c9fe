"""Label ladders: alert type, severity, sentiment, capitalisation tier and gauge bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds in percent, capitalisation bounds in currency units.
PUMP_1H, DUMP_1H = 5.0, -5.0
PUMP_24H, DUMP_24H = 10.0, -10.0
WHALE_RATIO = 2.0
SENTIMENT_MAJORITY = 60
CAP_BOUNDS = (1_000_000_000, 10_000_000_000)
CAP_TIERS = ("large_cap", "mid_cap", "small_cap")
GAUGE_BANDS = [(30, "Strong Bearish"), (45, "Bearish"), (55, "Neutral"), (70, "Bullish")]


def alert_type(change_1h: str = "price_change_percentage_1h",
               change_24h: str = "price_change_percentage_24h") -> Column:
    """First matching rule wins; the bounds themselves count; null where no rule matches."""
    hour, day = F.col(change_1h), F.col(change_24h)
    return (F.when(hour >= PUMP_1H, "PUMP_1H").when(hour <= DUMP_1H, "DUMP_1H")
            .when(day >= PUMP_24H, "PUMP_24H").when(day <= DUMP_24H, "DUMP_24H"))


def severity(change: Column) -> Column:
    """By size of the move: [10,20) LOW, [20,50] MEDIUM, above HIGH, smaller MINOR."""
    size = F.abs(change)
    return (F.when(size > 50, "HIGH").when(size >= 20, "MEDIUM").when(size >= 10, "LOW")
            .when(size.isNotNull(), "MINOR"))


def sentiment(bullish_pct: Column, bearish_pct: Column) -> Column:
    return (F.when(bullish_pct > SENTIMENT_MAJORITY, "BULLISH")
            .when(bearish_pct > SENTIMENT_MAJORITY, "BEARISH").otherwise("NEUTRAL"))


def majority(gainers: Column, losers: Column) -> Column:
    """Plain majority; a tie counts as bearish."""
    return F.when(gainers > losers, "BULLISH").otherwise("BEARISH")


def cap_tier(cap: Column, bounds: tuple[float, float] = CAP_BOUNDS) -> Column:
    mid, large = bounds
    return (F.when(cap >= large, CAP_TIERS[0]).when(cap >= mid, CAP_TIERS[1])
            .when(cap < mid, CAP_TIERS[2]))


def gauge_band(pct: Column) -> Column:
    ladder = F.when(pct < GAUGE_BANDS[0][0], GAUGE_BANDS[0][1])
    for upper, label in GAUGE_BANDS[1:]:
        ladder = ladder.when(pct < upper, label)
    return ladder.when(pct.isNotNull(), "Strong Bullish")


def traffic_light(pct: Column) -> Column:
    return F.when(pct < 40, "Red").when(pct <= 60, "Yellow").when(pct.isNotNull(), "Green")


def move_band(change: Column, bound: float) -> Column:
    """Table colouring: strictly above or below the bound."""
    return F.when(change > bound, "UP").when(change < -bound, "DOWN").otherwise("FLAT")
