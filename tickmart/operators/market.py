"""Market-wide analytics over the daily, weekly and monthly tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickmart.functions.calendar import as_column, days_before
from tickmart.functions.classify import CAP_BOUNDS, CAP_TIERS, cap_tier, majority
from tickmart.functions.formats import human_number
from tickmart.operators import alerts as alerts_ops
from tickmart.operators import serving
from tickmart.operators.rollup import COIN, percent_of

SHORT_TIMEFRAMES = ("24h", "7d")


def market_summary(latest: DataFrame) -> DataFrame:
    """One row: totals, average change, gainers against losers."""
    change = F.col("percent_change_24h")
    out = latest.agg(
        F.sum("market_cap").alias("total_market_cap"), F.sum("volume_24h").alias("total_volume_24h"),
        F.count("symbol").alias("coin_count"), F.round(F.avg(change), 2).alias("avg_change_24h"),
        F.count_if(change > 0).alias("gainers_count"), F.count_if(change < 0).alias("losers_count"),
    )
    return out.withColumns({
        "market_sentiment": majority(F.col("gainers_count"), F.col("losers_count")),
        "market_cap_label": human_number(F.col("total_market_cap")),
        "volume_label": human_number(F.col("total_volume_24h")),
    })


def cap_distribution(latest: DataFrame, bounds: tuple[float, float] = CAP_BOUNDS,
                     column: str = "market_cap") -> DataFrame:
    """Coins and capitalisation per tier; an empty tier is a row with zeros.

    All tiers come out of one global aggregate that unfolds into three rows.
    """
    tier = cap_tier(F.col(column), bounds)
    cells = [F.struct(F.lit(name).alias("tier"), F.count_if(tier == name).alias("coins"),
                      F.coalesce(F.sum(F.when(tier == name, F.col(column))), F.lit(0)).alias("total_market_cap"))
             for name in CAP_TIERS]
    return latest.agg(F.array(*cells).alias("tiers")).select(F.inline("tiers"))


def cap_distribution_daily(daily: DataFrame, bounds: tuple[float, float] = CAP_BOUNDS) -> DataFrame:
    return (daily.withColumn("tier", cap_tier(F.col("market_cap_close"), bounds)).where("tier IS NOT NULL")
            .groupBy("date", "tier").agg(F.count("*").alias("coins"),
                                         F.sum("market_cap_close").alias("total_market_cap")))


def share_of_cap(base: str) -> Column:
    """Percentage of the group's capitalisation held by one coin."""
    held = F.sum(F.when(F.col("coin_id") == base, F.col("market_cap_close")))
    return F.round(percent_of(held.cast("double"), F.sum("market_cap_close").cast("double")), 2)


def dominance(daily: DataFrame, bases: dict[str, str]) -> DataFrame:
    """Share of total capitalisation per day; ``bases`` maps output prefix to coin id."""
    shares = [share_of_cap(coin).alias(f"{prefix}_dominance") for prefix, coin in bases.items()]
    return daily.groupBy("date").agg(F.sum("market_cap_close").alias("total_market_cap"), *shares)


def market_daily(daily: DataFrame, base: str) -> DataFrame:
    """One row per day: totals, base coin's dominance, average move, advancing and declining coins."""
    move = F.col("return_pct_day")
    return daily.groupBy("date").agg(
        F.sum("market_cap_close").alias("total_market_cap"), F.sum("volume_sum_day").alias("total_volume"),
        share_of_cap(base).alias("base_dominance"), F.avg(move).alias("avg_change"),
        F.count_if(move > 0).alias("bullish_count"), F.count_if(move < 0).alias("bearish_count"),
    )


def hourly_volume(clean: DataFrame) -> DataFrame:
    """Volume per hour: each coin's last figure of the hour, summed over coins."""
    per_coin = clean.groupBy("date", "hour", "coin_id").agg(F.max_by("total_volume", "crawl_ts").alias("v"))
    return per_coin.groupBy("date", "hour").agg(F.sum("v").alias("total_volume"), F.count("*").alias("coins"))


def base_correlation(daily: DataFrame, base: str, min_points: int = 3) -> DataFrame:
    """Pearson correlation of daily returns of every other coin with the base coin.

    The base return of a day is taken by a window over that day's coins, the layout that the ranks already have.
    """
    is_base = F.col("coin_id") == base
    base_row = F.max(F.when(is_base, F.struct("symbol", "name", "return_pct_day"))).over(Window.partitionBy("date"))
    return (daily.withColumn("base_return", base_row["return_pct_day"]).where(~is_base)
            .where("return_pct_day IS NOT NULL AND base_return IS NOT NULL")
            .groupBy("coin_id").agg(F.corr("return_pct_day", "base_return").alias("correlation"),
                                    F.count("*").alias("days"))
            .where(F.col("days") >= min_points))


def volume_price_corr(daily: DataFrame, min_points: int = 3) -> DataFrame:
    return (daily.groupBy("coin_id").agg(F.corr("volume_sum_day", "close_price").alias("correlation"),
                                         F.count("*").alias("days"))
            .where(F.col("days") >= min_points))


def rank_changes(daily: DataFrame) -> DataFrame:
    """Movement of the closing rank against the coin's previous day; positive means it climbed."""
    by_day = Window.partitionBy("coin_id").orderBy("date", "symbol", "name")
    return daily.select("coin_id", "symbol", "date", "rank_close",
                        F.lag("rank_close").over(by_day).alias("previous_rank")) \
        .withColumn("rank_move", F.col("previous_rank") - F.col("rank_close"))


def change_over_days(close: str, days: int, latest: list[str]) -> Column:
    """Close against the close exactly ``days`` calendar days earlier.

    A range frame of that one day looks it up by date, so gaps do not shift it and no self-join is
    needed. The window covers one coin's days; ``latest`` orders several rows of one day.
    """
    by_date = Window.partitionBy("coin_id").orderBy(F.unix_date("date")).rangeBetween(-days, -days)
    then = F.max_by(close, F.struct(*latest)).over(by_date)
    return percent_of(F.col(close) - then, then)


def top_movers(clean: DataFrame, limit: int = 10, long_days: int = 30) -> DataFrame:
    """Strongest gainers and losers over 24 hours, 7 days and ``long_days`` days; the timeframe says which.

    One pass over the ticks: closing figures per coin and day, the long change from those, the newest
    day per coin. The rank filter becomes a group limit ahead of the shuffle, so of each list only
    ``limit`` rows per map task reach the ranking task.
    """
    figures = ["current_price", "total_volume", "price_change_percentage_24h", "price_change_percentage_7d"]
    closes = clean.groupBy("coin_id", "symbol", "date").agg(
        F.max("crawl_ts").alias("crawl_ts"), *[F.max_by(c, "crawl_ts").alias(c) for c in figures])
    changes = closes.withColumn("change_long", change_over_days("current_price", long_days, ["crawl_ts", "symbol"]))
    newest = changes.groupBy("coin_id").agg(
        F.max(F.struct("crawl_ts", "symbol", *figures, "change_long")).alias("f")).select("coin_id", "f.*")
    per_frame = newest.select(
        "coin_id", "symbol", F.col("current_price").alias("price"), F.col("total_volume").alias("volume"),
        F.stack(F.lit(3), F.lit(SHORT_TIMEFRAMES[0]), "price_change_percentage_24h",
                F.lit(SHORT_TIMEFRAMES[1]), "price_change_percentage_7d",
                F.lit(f"{long_days}d"), "change_long").alias("timeframe", "price_change_pct"))
    return _ranked_moves(per_frame, limit)


def _ranked_moves(moves: DataFrame, limit: int) -> DataFrame:
    move = F.col("price_change_pct")
    listed = moves.withColumn("type", F.when(move > 0, "gainers").when(move < 0, "losers")) \
        .where("type IS NOT NULL")
    order = Window.partitionBy("timeframe", "type").orderBy(F.desc(F.abs(move)), "coin_id", "symbol")
    return listed.withColumn("position", F.row_number().over(order)).where(F.col("position") <= limit)


def movers_of(latest: DataFrame, daily: DataFrame, limit: int = 10, long_days: int = 30) -> DataFrame:
    """Gainers and losers from the stored tables: the day's change as the snapshot has it, the long one from the closes
    of the daily table. A symbol stands for its coin."""
    day = latest.select(F.col("symbol").alias("coin_id"), "symbol", F.col("price_usd").alias("price"), F.col("volume_24h").alias("volume"),
                        F.lit(SHORT_TIMEFRAMES[0]).alias("timeframe"), F.col("percent_change_24h").alias("price_change_pct"))
    changes = daily.select("coin_id", "symbol", "name", "date", "close_price", "volume_sum_day").withColumn(
        "change", change_over_days("close_price", long_days, ["symbol", "name"]))
    newest = changes.groupBy("symbol").agg(F.max(F.struct("date", "coin_id", "close_price", "volume_sum_day", "change")).alias("r"))
    long_ = newest.select(F.col("symbol").alias("coin_id"), "symbol", F.col("r.close_price").alias("price"),
                          F.col("r.volume_sum_day").alias("volume"), F.lit(f"{long_days}d").alias("timeframe"),
                          F.col("r.change").alias("price_change_pct"))
    return _ranked_moves(day.unionByName(long_), limit)


def top_coin_trends(history: DataFrame, as_of, days: int = 7, top: int = 10) -> DataFrame:
    """Price trend of the coins that are largest by their newest capitalisation, in one aggregate."""
    recent = F.col("date") >= days_before(as_of, days)
    trends = serving.trend_columns(days, recent)
    largest = (history.groupBy("symbol").agg(F.max_by("market_cap", "date").alias("cap"), *trends)
               .orderBy(F.desc_nulls_last("cap"), "symbol").limit(top))
    return serving.with_trend(largest.where("points > 0"))


def price_heatmap(daily: DataFrame, dates: list | None = None) -> DataFrame:
    """Return by symbol and date; with ``dates`` given, one column per date."""
    if dates is None:
        return daily.groupBy("symbol", "date").agg(F.avg("return_pct_day").alias("return_pct"))
    keys = [str(d) for d in dates]
    text = daily.withColumn("date", F.col("date").cast("string"))
    return text.groupBy("symbol").pivot("date", keys).agg(F.avg("return_pct_day"))


def performance_compare(daily: DataFrame) -> DataFrame:
    """Return of each coin's newest day beside the returns so far of that day's week and month.

    Weekly and monthly returns follow from the first open of the period and the newest close, so
    the daily rows are laid out by coin once and everything else happens inside those partitions.
    """
    def since_open(*period: str) -> Column:
        span = Window.partitionBy(*COIN, *period).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
        opened, closed = (F.first("open_price", True).over(span), F.last("close_price", True).over(span))
        return percent_of(closed - opened, opened)

    by_coin = daily.repartition(*COIN).withColumns(
        {"return_pct_week": since_open("year", "week_of_year"), "return_pct_month": since_open("year", "month")})
    figures = F.struct("date", "return_pct_day", "return_pct_week", "return_pct_month")
    return by_coin.groupBy(*COIN).agg(F.max_by(figures, "date").alias("f")).select(*COIN, "f.*")


def most_volatile(daily: DataFrame, on, limit: int = 10) -> DataFrame:
    return (daily.where(F.col("date") == as_column(on))
            .select("coin_id", "symbol", "date", "volatility_day", "market_cap_rank_close")
            .orderBy(F.desc_nulls_last("volatility_day"), "market_cap_rank_close", "coin_id").limit(limit))


def overview(latest: DataFrame, history: DataFrame, alerts: DataFrame, as_of, symbols=("BTC", "ETH"),
             days: int = 7) -> dict[str, DataFrame]:
    """Everything the overview page shows, as unevaluated frames."""
    page = {"market_summary": market_summary(latest),
            "cap_distribution": cap_distribution(latest),
            "top_gainers": serving.top_gainers(latest), "top_losers": serving.top_losers(latest),
            "alerts_total": alerts_ops.alerts_total(alerts, as_of, days),
            "alerts_by_type": alerts_ops.alerts_by(alerts, "alert_type", as_of, days, 20),
            "alerts_by_severity": alerts_ops.alerts_by(alerts, "severity", as_of, days, 10),
            "alerts_by_day": alerts_ops.alerts_by_day(alerts, as_of, days)}
    page.update({f"trend_{s.lower()}": serving.price_trend(history, s, as_of, days) for s in symbols})
    return page
