"""Volume spikes from state kept in the stream: each coin's closed days of the last week, without a stored baseline.

Ticks become coin-days in a native windowed aggregate with a map-side step, so the keyed state below gets one row per
coin and day however often a coin ticks. That state is kept by ``transformWithState``, which runs in Python workers.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickmart.functions.classify import WHALE_RATIO
from tickmart.operators.rollup import COIN, first_by, last_by, percent_of
from tickmart.session import pin_state_store

# The processor travels by value, so the workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The columns of ``alerts.whale_detection``.
WHALE_DAY = ("coin_id string, symbol string, name string, date date, current_volume bigint, normal_volume double, "
             "volume_spike_pct double, return_pct_day double, close_price double")
DAY_MS = 86_400_000


def closed_days(ticks: DataFrame, lateness: str) -> DataFrame:
    """One row per coin and day, handed on once the watermark has passed the day's end."""
    return (
        ticks.withWatermark("crawl_ts", lateness).groupBy(*COIN, F.window("crawl_ts", "1 day").alias("window"))
        .agg(first_by("current_price", "crawl_ts").alias("open_price"), last_by("current_price", "crawl_ts").alias("close_price"),
             last_by("total_volume", "crawl_ts").alias("current_volume"))
        .select(*COIN, F.window_time("window").alias("closed_at"), F.to_date("window.start").alias("date"), "close_price", "current_volume",
                percent_of(F.col("close_price") - F.col("open_price"), F.col("open_price")).alias("return_pct_day"))
    )


class RollingVolume(StatefulProcessor):
    """Per coin the sum and number of volumes of each closed day; days leave after ``days``, the coin after as many idle ones."""

    def __init__(self, ratio: float, days: int):
        self.ratio, self.days = ratio, days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.volumes = handle.getMapState("volumes", "day int", "total double, n bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = {k[0]: (v[0], v[1]) for k, v in self.volumes.iterator()}
        arrived: dict[int, list[Row]] = {}
        for row in rows:
            arrived.setdefault(row.date.toordinal(), []).append(row)
        for day in sorted(arrived):  # several days close in one batch after a gap or a replay
            before = [known[d] for d in range(day - self.days, day) if d in known]
            count = sum(n for _, n in before)
            normal = sum(t for t, _ in before) / count if count else None
            for row in arrived[day]:
                spike = row.current_volume / normal * 100 if normal and row.current_volume is not None else None
                if spike is not None and spike > self.ratio * 100:
                    yield Row(coin_id=row.coin_id, symbol=row.symbol, name=row.name, date=row.date, current_volume=row.current_volume,
                              normal_volume=normal, volume_spike_pct=spike, return_pct_day=row.return_pct_day, close_price=row.close_price)
            volumes = [float(row.current_volume) for row in arrived[day] if row.current_volume is not None]
            total, n = known.get(day, (0.0, 0))
            known[day] = (total + sum(volumes), n + len(volumes))
            self.volumes.updateValue((day,), known[day])
        newest = max(known)
        for day in [d for d in known if d <= newest - self.days]:
            self.volumes.removeKey((day,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # The last day that still counts this coin's newest one closes ``days + 1`` midnights after it began.
        midnight = (newest - dt.date(1970, 1, 1).toordinal()) * DAY_MS
        self.handle.registerTimer(midnight + (self.days + 1) * DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.volumes.clear()
        return iter(())

    def close(self) -> None:
        pass


def whale_days(ticks: DataFrame, lateness: str, ratio: float = WHALE_RATIO, days: int = 7) -> DataFrame:
    """Coin-days whose last volume exceeds ``ratio`` x the average of the ``days`` calendar days before.

    The streamed form of ``alerts.whale_detection``: a day is judged once, when the watermark closes it, from days that are closed
    themselves; the day still open has no row yet. Append mode. Rows of a coin wait in one task as one row a day, and
    its state is at most ``days + 1`` small entries.
    """
    pin_state_store(ticks.sparkSession)
    return closed_days(ticks, lateness).groupBy("coin_id").transformWithState(
        RollingVolume(ratio, days), WHALE_DAY, "Append", "eventTime")
