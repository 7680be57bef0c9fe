"""Lookups behind the dashboard and the query API: snapshot, history, lists, search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickmart.functions import timeframes
from tickmart.functions.calendar import as_column, days_before
from tickmart.functions.formats import human_number
from tickmart.functions.matching import word_distance
from tickmart.operators.rollup import COIN

SNAPSHOT_MEASURES = ["current_price", "market_cap", "total_volume", "market_cap_rank",
                     "price_change_percentage_24h", "price_change_percentage_7d"]


# --- builders of the serving tables -----------------------------------------------------------

def latest_per_coin(clean: DataFrame, *per: str) -> DataFrame:
    """Newest tick of every coin, or of every coin and ``per``. Only fixed-width buffers, so ticks fold in a hash
    aggregate."""
    return clean.groupBy(*COIN, *per).agg(F.max("crawl_ts").alias("crawl_ts"),
                                    *[F.max_by(c, "crawl_ts").alias(c) for c in SNAPSHOT_MEASURES])


def latest_snapshot(clean: DataFrame) -> DataFrame:
    """Newest row per symbol. The second step picks among coins that share or changed a symbol."""
    row = F.struct("crawl_ts", "coin_id", "name", *SNAPSHOT_MEASURES)
    picked = latest_per_coin(clean).groupBy("symbol").agg(F.max(row).alias("r"))
    return picked.select(
        "symbol", "r.name", F.col("r.current_price").alias("price_usd"), "r.market_cap",
        F.col("r.total_volume").alias("volume_24h"),
        F.col("r.price_change_percentage_24h").alias("percent_change_24h"),
        F.col("r.market_cap_rank").alias("rank"), F.col("r.crawl_ts").alias("last_updated"))


def history_table(daily: DataFrame) -> DataFrame:
    return daily.select("symbol", "name", "date", F.col("close_price").alias("price_usd"),
                        F.col("high_price").alias("price_high"), F.col("low_price").alias("price_low"),
                        F.col("market_cap_close").alias("market_cap"),
                        F.col("volume_sum_day").alias("volume_24h"))


# --- price history and trend ------------------------------------------------------------------

def prices_since(history: DataFrame, symbol: str, as_of, days: int) -> DataFrame:
    return history.where((F.col("symbol") == symbol.upper()) & (F.col("date") >= days_before(as_of, days)))


def price_history(history: DataFrame, symbol: str, as_of, days: int = 7, limit: int | None = None) -> DataFrame:
    """Daily prices of one symbol from ``days`` days before ``as_of``, oldest first; all of them, or the first ``limit``."""
    found = prices_since(history, symbol, as_of, days).orderBy("date", "name")
    return found if limit is None else found.limit(limit)


def trend_columns(days: int, among: Column | None = None) -> list[Column]:
    """Trend figures over the rows with ``date`` and ``price_usd`` for which ``among`` holds.

    A zero end point counts as 1, a missing price as 0.
    """
    among = F.lit(True) if among is None else among
    price = F.when(among, F.coalesce("price_usd", F.lit(0.0)))
    date = F.when(among, F.col("date"))

    def end_point(value: Column) -> Column:
        return F.when(value == 0, F.lit(1.0)).otherwise(value)

    return [
        F.count_if(among).alias("points"), F.lit(days).alias("period_days"),
        end_point(F.min_by(price, date)).alias("first_price"),
        end_point(F.max_by(price, date)).alias("last_price"),
        F.avg(price).alias("avg_price"), F.min(price).alias("min_price"), F.max(price).alias("max_price"),
    ]


def with_trend(df: DataFrame) -> DataFrame:
    first, last = F.col("first_price"), F.col("last_price")
    change = (last - first) / first * 100
    enough = F.col("points") >= 2
    figures = {c: F.when(enough, F.col(c))
               for c in ("first_price", "last_price", "avg_price", "min_price", "max_price")}
    return df.select(
        "symbol", "period_days", *[v.alias(c) for c, v in figures.items()],
        F.when(enough, F.round(change, 2)).alias("price_change_percent"),
        F.when(enough, F.when(change > 0, "UP").otherwise("DOWN")).alias("trend"),
        F.when(~enough, "not enough data").alias("error"))


def price_trend(history: DataFrame, symbol: str, as_of, days: int = 7) -> DataFrame:
    """One row of trend figures; with fewer than two points only the error text is filled."""
    rows = prices_since(history, symbol, as_of, days)
    return with_trend(rows.agg(*trend_columns(days)).withColumn("symbol", F.lit(symbol.upper())))


def history_interval(clean: DataFrame, coin_id: str, as_of, days: int = 7, interval: str = "daily") -> DataFrame:
    """Last price, volume and capitalisation of one coin per hour or day."""
    unit = {"hourly": "hour", "daily": "day"}[interval]
    recent = clean.where((F.col("coin_id") == coin_id) & (F.col("date") >= days_before(as_of, days)))
    return recent.groupBy("coin_id", F.date_trunc(unit, "crawl_ts").alias("timestamp")).agg(
        F.max_by("current_price", "crawl_ts").alias("price"),
        F.max_by("total_volume", "crawl_ts").alias("volume"),
        F.max_by("market_cap", "crawl_ts").alias("market_cap")).orderBy("timestamp")


# --- lists over the snapshot ------------------------------------------------------------------

MOVER_COLUMNS = ["symbol", "name", "price_usd", "percent_change_24h", "volume_24h"]


def top_gainers(latest: DataFrame, limit: int = 10) -> DataFrame:
    return (latest.where("percent_change_24h > 0").orderBy(F.desc("percent_change_24h"), "symbol")
            .limit(limit).select(*MOVER_COLUMNS))


def top_losers(latest: DataFrame, limit: int = 10) -> DataFrame:
    return (latest.where("percent_change_24h < 0").orderBy("percent_change_24h", "symbol")
            .limit(limit).select(*MOVER_COLUMNS))


def cap_ranking(latest: DataFrame, limit: int = 20) -> DataFrame:
    """Largest coins with their position; numbering happens on the ``limit`` rows that are left."""
    top = latest.orderBy(F.desc_nulls_last("market_cap"), "symbol").limit(limit)
    position = F.row_number().over(Window.orderBy(F.desc_nulls_last("market_cap"), "symbol"))
    return top.select("symbol", "name", "market_cap", "price_usd", "rank", "volume_24h",
                      position.alias("current_rank"))


def filter_coins(latest: DataFrame, min_market_cap=None, max_market_cap=None, min_price=None,
                 max_price=None, min_change=None, max_change=None, limit: int = 50) -> DataFrame:
    """Coins within inclusive bounds, largest first. A bound of 0 is a bound."""
    bounds = [("market_cap", min_market_cap, max_market_cap), ("price_usd", min_price, max_price),
              ("percent_change_24h", min_change, max_change)]
    for column, low, high in bounds:
        if low is not None:
            latest = latest.where(F.col(column) >= low)
        if high is not None:
            latest = latest.where(F.col(column) <= high)
    return latest.orderBy(F.desc_nulls_last("market_cap"), "symbol").limit(limit)


def latest_page(latest: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    return latest.orderBy(F.asc_nulls_last("rank"), "symbol").offset(offset).limit(limit)


def coin_detail(latest: DataFrame, symbol: str) -> DataFrame:
    return latest.where(F.col("symbol") == symbol.upper()).limit(1)


def search_coin(coins: DataFrame, keyword: str, limit: int = 20, name: str = "name", symbol: str = "symbol",
                size: str = "market_cap", key: str = "symbol") -> DataFrame:
    """Coins whose name is close to or contains the keyword, or whose symbol contains it.

    Best match first: exact symbol, exact name, fewest edits, then the larger coin.
    """
    text, code = F.col(name), F.col(symbol)
    found = coins.withColumn("distance", word_distance(text, keyword)).where(
        F.col("distance").isNotNull() | F.contains(F.lower(text), F.lit(keyword.lower()))
        | F.contains(code, F.lit(keyword.upper())))
    return found.orderBy(
        F.desc_nulls_last(code == keyword.upper()), F.desc_nulls_last(F.lower(text) == keyword.lower()),
        F.asc_nulls_last("distance"), F.desc_nulls_last(size), key).limit(limit)


# --- newest or chosen period of a metric table ------------------------------------------------

def report(metrics: DataFrame, timeframe: str, period: list[str], newest_only: bool, limit: int) -> DataFrame:
    """Best returns, of the newest period only or of whatever rows came in.

    The newest period needs no second pass: ordered by period first, its best rows come first, and
    what follows them in the ``limit`` rows belongs to older periods and is cut off.
    """
    order = [F.desc_nulls_last(timeframes.columns(timeframe)["return"]), *COIN]
    if not newest_only:
        return metrics.orderBy(*order).limit(limit)
    top = metrics.orderBy(*[F.desc(p) for p in period], *order).limit(limit)
    newest = F.max(F.struct(*period)).over(Window.partitionBy())
    return top.withColumn("_newest", newest).where(F.struct(*period) == F.col("_newest")).drop("_newest")


def daily_report(daily: DataFrame, limit: int = 100, date=None) -> DataFrame:
    """Coins of one day by return; the newest day unless one is given."""
    chosen = daily if date is None else daily.where(F.col("date") == as_column(date))
    return report(chosen, "daily", ["date"], date is None, limit).select(
        "date", *COIN, "open_price", "close_price", "high_price", "low_price", "return_pct_day",
        "volatility_day", "volume_sum_day", "market_cap_close", "rank_close")


def period_report(metrics: DataFrame, timeframe: str, part: str, limit: int, year: int | None,
                  value: int | None) -> DataFrame:
    if year is not None:
        metrics = metrics.where(F.col("year") == year)
    if value is not None:
        metrics = metrics.where(F.col(part) == value)
    cols, suffix = timeframes.columns(timeframe), timeframes.SUFFIX[timeframe]
    return report(metrics, timeframe, ["year", part], year is None and value is None, limit).select(
        "year", part, f"{suffix}_start_date", f"{suffix}_end_date", *COIN, cols["open"], cols["close"],
        cols["high"], cols["low"], cols["return"], cols["volatility"], cols["volume"])


def weekly_report(weekly: DataFrame, limit: int = 100, year: int | None = None,
                  week: int | None = None) -> DataFrame:
    return period_report(weekly, "weekly", "week_of_year", limit, year, week)


def monthly_report(monthly: DataFrame, limit: int = 100, year: int | None = None,
                   month: int | None = None) -> DataFrame:
    return period_report(monthly, "monthly", "month", limit, year, month)


# --- dashboard page ---------------------------------------------------------------------------

def movers_table(metrics: DataFrame, timeframe: str = "daily", show: str = "all", limit: int = 20) -> DataFrame:
    """Largest moves in either direction with their position in the list."""
    c = timeframes.columns(timeframe)
    ret = F.col(c["return"])
    if show == "gainers":
        metrics = metrics.where(ret > 0)
    elif show == "losers":
        metrics = metrics.where(ret < 0)
    order = [F.desc_nulls_last(F.abs(ret)), *COIN]
    top = metrics.orderBy(*order).limit(limit)
    # Numbered after the limit: the single window group has ``limit`` rows.
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("position"), *COIN,
                      *[c[k] for k in ("open", "close", "high", "low", "return", "volatility", "volume")],
                      F.when(ret >= 0, "positive").otherwise("negative").alias("direction"))


def chart_top_volume(metrics: DataFrame, timeframe: str = "daily", limit: int = 10) -> DataFrame:
    c = timeframes.columns(timeframe)
    return metrics.orderBy(F.desc_nulls_last(c["volume"]), *COIN).limit(limit) \
        .select(*COIN, c["return"], c["volume"])


def summary_cards(metrics: DataFrame, timeframe: str = "daily", by: Sequence[str] = ()) -> DataFrame:
    """Best, worst, most volatile and most traded coin and the number of coins, over all rows or one row of cards for each
    period that the ``by`` columns name."""
    c = timeframes.columns(timeframe)

    def extreme(column: str, best: bool) -> Column:
        # The id breaks ties; the smaller id wins in both directions. A null order is skipped.
        value = F.col(column)
        order = F.struct((-value if best else value).alias("k"), *COIN)
        return F.min_by(F.struct("symbol", value.alias("v")), F.when(value.isNotNull(), order))

    present = F.col(c["return"]).isNotNull()
    cards = metrics.where(present).groupBy(*by).agg(
        extreme(c["return"], True).alias("g"), extreme(c["return"], False).alias("l"),
        extreme(c["volatility"], True).alias("v"), extreme(c["volume"], True).alias("q"),
        F.count("*").alias("coins"))
    return cards.select(
        *by, F.col("g.symbol").alias("top_gainer"), F.col("g.v").alias("top_gainer_change"),
        F.col("l.symbol").alias("top_loser"), F.col("l.v").alias("top_loser_change"),
        F.col("v.symbol").alias("most_volatile"), F.col("v.v").alias("most_volatile_value"),
        F.col("q.symbol").alias("highest_volume"), F.col("q.v").alias("highest_volume_value"),
        human_number(F.col("q.v"), prefix="", units="BMK").alias("highest_volume_label"), "coins")
