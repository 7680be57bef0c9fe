"""Plain SQL for every catalog query, written for another engine and independent of the operators."""

from __future__ import annotations

import re

# Shared named subqueries. A statement gets exactly those it mentions, in this order.
VIEWS = {
    "clock": "SELECT max(ts) AS t, CAST(max(ts) AS DATE) AS d FROM events",
    "ev": """
        SELECT event_id, ts, event_type, value, CAST(user_id % 20 AS INT) AS k,
               CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS jk FROM events""",
    "live": """
        SELECT concat('coin-', k) AS coin_id, concat('C', k) AS symbol, concat('Coin ', k) AS name,
               ts AS crawl_ts, ts AS last_updated, event_type AS source, value AS current_price,
               CAST(round(value * 100) AS BIGINT) * 1000 * (k + 1) AS market_cap, k + 1 AS market_cap_rank,
               (event_id * 7919) % 1000000 AS total_volume,
               CAST(jk - 50 AS DOUBLE) / 5 AS price_change_percentage_1h,
               CAST((event_id * 37) % 401 - 200 AS DOUBLE) / 10 AS price_change_percentage_24h,
               CAST((event_id * 53) % 551 - 250 AS DOUBLE) / 10 AS price_change_percentage_7d
        FROM ev""",
    "ticks": "SELECT * REPLACE (CAST(date_trunc('hour', crawl_ts) AS TIMESTAMP) AS crawl_ts) FROM live",
    "spoiled": """
        SELECT * REPLACE (
            CASE WHEN total_volume % 13 = 0 THEN NULL WHEN total_volume % 17 = 0 THEN -1.0 WHEN total_volume % 19 = 0 THEN 0.0
                 ELSE current_price END AS current_price,
            CASE WHEN total_volume % 23 = 0 THEN NULL WHEN total_volume % 29 = 0 THEN 0 ELSE market_cap END AS market_cap,
            CASE WHEN total_volume % 31 = 0 THEN NULL WHEN total_volume % 37 = 0 THEN -total_volume ELSE total_volume END AS total_volume,
            CASE WHEN total_volume % 41 <> 0 THEN coin_id END AS coin_id, CASE WHEN total_volume % 43 <> 0 THEN symbol END AS symbol)
        FROM ticks""",
    "uniq_spoiled": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY coin_id, crawl_ts ORDER BY last_updated DESC) AS rn
            FROM spoiled) WHERE rn = 1""",
    "clean_spoiled": """
        SELECT *, CAST(crawl_ts AS DATE) AS date, CAST(hour(crawl_ts) AS INT) AS hour,
               CAST(dayofweek(crawl_ts) + 1 AS INT) AS day_of_week, CAST(week(crawl_ts) AS INT) AS week_of_year,
               CAST(month(crawl_ts) AS INT) AS month, CAST(year(crawl_ts) AS INT) AS year
        FROM uniq_spoiled
        WHERE current_price > 0 AND market_cap > 0 AND total_volume >= 0
          AND coin_id IS NOT NULL AND symbol IS NOT NULL""",
    "uniq": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY coin_id, crawl_ts ORDER BY last_updated DESC) AS rn
            FROM ticks) WHERE rn = 1""",
    "clean": """
        SELECT *, CAST(crawl_ts AS DATE) AS date, CAST(hour(crawl_ts) AS INT) AS hour,
               CAST(dayofweek(crawl_ts) + 1 AS INT) AS day_of_week, CAST(week(crawl_ts) AS INT) AS week_of_year,
               CAST(month(crawl_ts) AS INT) AS month, CAST(year(crawl_ts) AS INT) AS year
        FROM uniq
        WHERE current_price > 0 AND market_cap > 0 AND total_volume >= 0
          AND coin_id IS NOT NULL AND symbol IS NOT NULL""",
    "ohlc": """
        SELECT coin_id, symbol, name, date,
               arg_min(current_price, crawl_ts) AS open_price, arg_max(current_price, crawl_ts) AS close_price,
               max(current_price) AS high_price, min(current_price) AS low_price,
               arg_max(total_volume, crawl_ts) AS volume_sum_day, arg_max(market_cap, crawl_ts) AS market_cap_close,
               arg_max(market_cap_rank, crawl_ts) AS market_cap_rank_close, count(*) AS record_count
        FROM clean GROUP BY coin_id, symbol, name, date""",
    "ohlc_live": """
        SELECT coin_id, CAST(crawl_ts AS DATE) AS date, arg_max(current_price, crawl_ts) AS close_price,
               arg_max(total_volume, crawl_ts) AS volume_sum_day, count(*) AS record_count
        FROM live WHERE current_price > 0 AND market_cap > 0 AND total_volume >= 0 GROUP BY ALL""",
    "ohlc_orders": """
        SELECT o_orderpriority AS coin_id, o_orderpriority AS symbol, o_orderpriority AS name,
               CAST(o_orderdate AS DATE) AS date,
               arg_min(o_totalprice, o_orderkey) AS open_price, arg_max(o_totalprice, o_orderkey) AS close_price,
               max(o_totalprice) AS high_price, min(o_totalprice) AS low_price,
               arg_max(o_custkey, o_orderkey) AS volume_sum_day, arg_max(o_custkey, o_orderkey) AS market_cap_close,
               1 AS market_cap_rank_close, count(*) AS record_count
        FROM orders GROUP BY ALL""",
}


def metrics_view(source: str) -> str:
    return f"""
        SELECT date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
               CAST(week(date) AS INT) AS week_of_year, CAST(dayofweek(date) + 1 AS INT) AS day_of_week,
               coin_id, symbol, name, open_price, close_price, high_price, low_price,
               CASE WHEN open_price <> 0 THEN (close_price - open_price) / open_price * 100 END AS return_pct_day,
               CASE WHEN open_price <> 0 THEN (high_price - low_price) / open_price * 100 END AS volatility_day,
               high_price - low_price AS price_range_day,
               volume_sum_day, market_cap_close, market_cap_rank_close,
               CAST(row_number() OVER (PARTITION BY date ORDER BY open_price DESC, coin_id) AS INT) AS rank_open,
               CAST(row_number() OVER (PARTITION BY date ORDER BY close_price DESC, coin_id) AS INT) AS rank_close,
               CAST(row_number() OVER (PARTITION BY date ORDER BY open_price DESC, coin_id) AS INT)
                 - CAST(row_number() OVER (PARTITION BY date ORDER BY close_price DESC, coin_id) AS INT) AS rank_change,
               record_count
        FROM {source}"""


def rollup_sql(source: str, year: str, part: str, s: str) -> str:
    """Weekly or monthly rollup; averages rounded like the catalog does."""
    return f"""
        SELECT *, (close_price_{s} - open_price_{s}) / open_price_{s} * 100 AS return_pct_{s},
               (high_price_{s} - low_price_{s}) / open_price_{s} * 100 AS volatility_{s}
        FROM (
            SELECT {year} AS year, {part}, min(date) AS {s}_start_date, max(date) AS {s}_end_date,
                   coin_id, symbol, name,
                   arg_min(open_price, date) AS open_price_{s}, arg_max(close_price, date) AS close_price_{s},
                   max(high_price) AS high_price_{s}, min(low_price) AS low_price_{s},
                   round(avg(volatility_day), 6) AS avg_volatility_{s},
                   CAST(sum(volume_sum_day) AS BIGINT) AS volume_sum_{s},
                   round(avg(rank_close), 6) AS avg_rank_{s}, count(*) AS days_in_{s}
            FROM {source} GROUP BY ALL)"""


VIEWS.update({
    "daily": metrics_view("ohlc"),
    "orders_daily": metrics_view("ohlc_orders"),
    "weekly": rollup_sql("daily", "year", "week_of_year", "week"),
    "monthly": rollup_sql("daily", "year", "month", "month"),
    "latest": """
        SELECT symbol, name, current_price AS price_usd, market_cap, total_volume AS volume_24h,
               price_change_percentage_24h AS percent_change_24h, market_cap_rank AS rank, crawl_ts AS last_updated
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY crawl_ts DESC, coin_id DESC) AS rn FROM clean)
        WHERE rn = 1""",
    "history": """
        SELECT symbol, name, date, close_price AS price_usd, high_price AS price_high, low_price AS price_low,
               market_cap_close AS market_cap, volume_sum_day AS volume_24h FROM daily""",
    "alerted": """
        SELECT * FROM (
            SELECT *, CASE WHEN price_change_percentage_1h >= 5 THEN 'PUMP_1H'
                           WHEN price_change_percentage_1h <= -5 THEN 'DUMP_1H'
                           WHEN price_change_percentage_24h >= 10 THEN 'PUMP_24H'
                           WHEN price_change_percentage_24h <= -10 THEN 'DUMP_24H' END AS alert_type
            FROM live) WHERE alert_type IS NOT NULL""",
    "whales": """
        SELECT *, volume_sum_day / normal_volume * 100 AS spike FROM (
            SELECT *, avg(volume_sum_day) OVER (PARTITION BY coin_id ORDER BY date
                RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS normal_volume FROM daily)
        WHERE volume_sum_day / normal_volume * 100 > 200""",
    "alert_rows": """
        SELECT symbol, name, alert_type,
               CASE WHEN alert_type LIKE '%_1H' THEN price_change_percentage_1h
                    ELSE price_change_percentage_24h END AS price_change_percent,
               current_price, crawl_ts AS detected_at FROM alerted
        UNION ALL
        SELECT symbol, name, 'WHALE_ALERT', return_pct_day, close_price, CAST(date AS TIMESTAMP) FROM whales""",
    "alert_store": """
        SELECT *, CASE WHEN abs(price_change_percent) > 50 THEN 'HIGH' WHEN abs(price_change_percent) >= 20 THEN 'MEDIUM'
                       WHEN abs(price_change_percent) >= 10 THEN 'LOW'
                       WHEN price_change_percent IS NOT NULL THEN 'MINOR' END AS severity
        FROM alert_rows""",
    "recent_store": "SELECT * FROM alert_store WHERE CAST(detected_at AS DATE) >= (SELECT d FROM clock) - 7",
    "all_days": """
        SELECT CAST(detected_at AS DATE) AS date, count(*) AS n FROM alert_store
        WHERE CAST(detected_at AS DATE) >= (SELECT d FROM clock) - 30 GROUP BY ALL""",
    "rare_days": """
        SELECT CAST(detected_at AS DATE) AS date, count(*) AS n FROM alert_store
        WHERE alert_type = 'WHALE_ALERT' AND severity = 'HIGH'
          AND CAST(detected_at AS DATE) >= (SELECT d FROM clock) - 30 GROUP BY ALL""",
    "pumps": """
        SELECT coin_id, symbol, name, date, CASE WHEN return_pct_day > 0 THEN 'PUMP' ELSE 'DUMP' END AS type,
               return_pct_day AS price_change_pct, round(spike, 6) AS volume_change_pct,
               CASE WHEN abs(return_pct_day) > 50 THEN 'HIGH' WHEN abs(return_pct_day) >= 20 THEN 'MEDIUM'
                    ELSE 'LOW' END AS severity
        FROM whales WHERE abs(return_pct_day) > 10""",
})


def mood(source: str, bucket: str, name: str, change: str, average: str) -> str:
    return f"""
        SELECT *, CASE WHEN bullish_pct > 60 THEN 'BULLISH' WHEN bearish_pct > 60 THEN 'BEARISH'
                       ELSE 'NEUTRAL' END AS sentiment
        FROM (SELECT {bucket} AS {name}, count(*) AS total_coins,
                     count(*) FILTER (WHERE {change} > 0) AS bullish_count,
                     count(*) FILTER (WHERE {change} < 0) AS bearish_count,
                     count(*) FILTER (WHERE {change} = 0) AS neutral_count,
                     round(count(*) FILTER (WHERE {change} > 0) / count(*) * 100, 2) AS bullish_pct,
                     round(count(*) FILTER (WHERE {change} < 0) / count(*) * 100, 2) AS bearish_pct,
                     CASE WHEN round(avg({change}), 6) = 0 THEN 0 ELSE round(avg({change}), 6) END AS {average}
              FROM {source} GROUP BY ALL)"""


MINUTE = "CAST(date_trunc('minute', crawl_ts) AS TIMESTAMP)"
VIEWS["mood_live"] = mood("live", MINUTE, "window_start", "price_change_percentage_24h", "avg_change_24h")


def trend_sql(source: str) -> str:
    return f"""
        SELECT symbol, 7 AS period_days, CASE WHEN n >= 2 THEN a END AS first_price, CASE WHEN n >= 2 THEN z END AS last_price,
               CASE WHEN n >= 2 THEN round(av, 6) END AS avg_price, CASE WHEN n >= 2 THEN lo END AS min_price,
               CASE WHEN n >= 2 THEN hi END AS max_price, CASE WHEN n >= 2 THEN round((z - a) / a * 100, 2) END AS price_change_percent,
               CASE WHEN n >= 2 THEN CASE WHEN z > a THEN 'UP' ELSE 'DOWN' END END AS trend,
               CASE WHEN n < 2 THEN 'not enough data' END AS error
        FROM (SELECT symbol, count(*) AS n, coalesce(nullif(arg_min(price_usd, date), 0), 1) AS a,
                     coalesce(nullif(arg_max(price_usd, date), 0), 1) AS z, avg(price_usd) AS av,
                     min(price_usd) AS lo, max(price_usd) AS hi FROM {source} GROUP BY symbol)"""


def movers_sql(newest: str, closes: str, days: int) -> str:
    return f"""
        SELECT coin_id, symbol, price, volume, timeframe, type, price_change_pct, CAST(rn AS INT) AS position FROM (
            SELECT *, row_number() OVER (PARTITION BY timeframe, type ORDER BY abs(price_change_pct) DESC, coin_id) AS rn
            FROM (SELECT *, CASE WHEN price_change_pct > 0 THEN 'gainers' WHEN price_change_pct < 0 THEN 'losers' END AS type
                  FROM (SELECT coin_id, symbol, price, volume, '24h' AS timeframe, c24 AS price_change_pct FROM {newest}
                        UNION ALL SELECT coin_id, symbol, price, volume, '7d', c7 FROM {newest}
                        UNION ALL SELECT n.coin_id, n.symbol, n.price, n.volume, '{days}d',
                                         (a.close_price - b.close_price) / b.close_price * 100
                                  FROM {newest} n JOIN {closes} a ON a.coin_id = n.coin_id AND a.date = n.d
                                  JOIN {closes} b ON b.coin_id = n.coin_id AND b.date = n.d - {days}))
            WHERE type IS NOT NULL) WHERE rn <= 10"""


def cards_sql(source: str, s: str) -> str:
    return f"""
        SELECT g.symbol AS top_gainer, g.return_pct_{s} AS top_gainer_change, l.symbol AS top_loser,
               l.return_pct_{s} AS top_loser_change, v.symbol AS most_volatile, v.volatility_{s} AS most_volatile_value,
               q.symbol AS highest_volume, q.volume_sum_{s} AS highest_volume_value,
               CASE WHEN q.volume_sum_{s} >= 1e9 THEN printf('%.2fB', q.volume_sum_{s} / 1e9)
                    WHEN q.volume_sum_{s} >= 1e6 THEN printf('%.2fM', q.volume_sum_{s} / 1e6)
                    WHEN q.volume_sum_{s} >= 1e3 THEN printf('%.2fK', q.volume_sum_{s} / 1e3)
                    ELSE printf('%.2f', CAST(q.volume_sum_{s} AS DOUBLE)) END AS highest_volume_label,
               (SELECT count(*) FROM {source}) AS coins
        FROM (SELECT * FROM {source} ORDER BY return_pct_{s} DESC, coin_id LIMIT 1) g,
             (SELECT * FROM {source} ORDER BY return_pct_{s}, coin_id LIMIT 1) l,
             (SELECT * FROM {source} ORDER BY volatility_{s} DESC, coin_id LIMIT 1) v,
             (SELECT * FROM {source} ORDER BY volume_sum_{s} DESC, coin_id LIMIT 1) q"""


def weekly_cards_sql() -> str:
    best = lambda column, value, order: f"arg_min({column}, ({order}, coin_id)) FILTER ({value} IS NOT NULL)"
    return f"""
        SELECT *, CASE WHEN highest_volume_value >= 1e9 THEN printf('%.2fB', highest_volume_value / 1e9)
                       WHEN highest_volume_value >= 1e6 THEN printf('%.2fM', highest_volume_value / 1e6)
                       WHEN highest_volume_value >= 1e3 THEN printf('%.2fK', highest_volume_value / 1e3)
                       ELSE printf('%.2f', CAST(highest_volume_value AS DOUBLE)) END AS highest_volume_label
        FROM (SELECT year, week_of_year, {best('symbol', 'return_pct_week', '-return_pct_week')} AS top_gainer, max(return_pct_week) AS top_gainer_change,
                     {best('symbol', 'return_pct_week', 'return_pct_week')} AS top_loser, min(return_pct_week) AS top_loser_change,
                     {best('symbol', 'volatility_week', '-volatility_week')} AS most_volatile, max(volatility_week) AS most_volatile_value,
                     {best('symbol', 'volume_sum_week', '-volume_sum_week')} AS highest_volume, max(volume_sum_week) AS highest_volume_value,
                     count(*) AS coins
              FROM weekly WHERE return_pct_week IS NOT NULL GROUP BY year, week_of_year)"""


KQL_WHERE = {
    "cap_above": "market_cap_close > 5000000", "volume_above": "volume_sum_day > 500000", "volatility_above": "volatility_day > 1000",
    "return_above": "return_pct_day > 10", "return_below": "return_pct_day < -10",
    "cap_between": "market_cap_close BETWEEN 1000000 AND 50000000", "symbols": "symbol IN ('C0', 'C3')",
    "without": "symbol NOT IN ('C0', 'C1')",
}


def money(value: str) -> str:
    return f"""CASE WHEN {value} >= 1e12 THEN printf('$%.2fT', {value} / 1e12)
        WHEN {value} >= 1e9 THEN printf('$%.2fB', {value} / 1e9) WHEN {value} >= 1e6 THEN printf('$%.2fM', {value} / 1e6)
        WHEN {value} >= 1e3 THEN printf('$%.2fK', {value} / 1e3) ELSE printf('$%.2f', CAST({value} AS DOUBLE)) END"""


def tier(column: str) -> str:
    return (f"CASE WHEN {column} >= 200000000 THEN 'large_cap' WHEN {column} >= 50000000 THEN 'mid_cap' "
            f"ELSE 'small_cap' END")


def share(coin: str) -> str:
    return (f"round(CAST(sum(market_cap_close) FILTER (WHERE coin_id = '{coin}') AS DOUBLE) "
            f"/ CAST(sum(market_cap_close) AS DOUBLE) * 100, 2)")


ISO = "'%Y-%m-%dT00:00:00.000Z'"
DAILY_COLS = ("year, month, week_of_year, day_of_week, coin_id, symbol, name, open_price, close_price, high_price, "
              "low_price, return_pct_day, volatility_day, price_range_day, volume_sum_day, market_cap_close, "
              "market_cap_rank_close, rank_open, rank_close, rank_change, record_count")
TICK_COLS = ("coin_id, symbol, name, crawl_ts, last_updated, source, current_price, market_cap, market_cap_rank, "
             "total_volume, price_change_percentage_1h, price_change_percentage_24h, price_change_percentage_7d")

SQL = {
    # cleaning
    "clean_cast": """
        SELECT coin_id, last_updated, CASE WHEN total_volume % 97 <> 0 THEN market_cap END AS market_cap,
               CASE WHEN total_volume % 97 <> 0 THEN market_cap_rank END AS market_cap_rank,
               CASE WHEN total_volume % 97 <> 0 THEN total_volume END AS total_volume,
               CASE WHEN total_volume % 89 <> 0 THEN current_price END AS current_price,
               CAST(concat(market_cap, '.9') AS DOUBLE) AS max_supply FROM ticks""",
    "dedup_latest": f"SELECT {TICK_COLS} FROM uniq",
    "dedup_hourly": """
        SELECT coin_id, max(crawl_ts) AS crawl_ts, arg_max(current_price, crawl_ts) AS current_price,
               arg_max(total_volume, crawl_ts) AS total_volume
        FROM live GROUP BY coin_id, date_trunc('hour', crawl_ts)""",
    "clean_validate": f"""SELECT {TICK_COLS} FROM spoiled WHERE current_price > 0 AND market_cap > 0
        AND total_volume >= 0 AND coin_id IS NOT NULL AND symbol IS NOT NULL""",
    "clean_ticks": "SELECT * FROM clean_spoiled",
    "quality_report": """
        SELECT r.n AS raw_records, r.n - u.n AS duplicates_removed, u.n - c.n AS invalid_removed,
               c.n AS clean_records, round(c.n / r.n * 100, 2) AS quality_pct, c.p AS partitions
        FROM (SELECT count(*) AS n FROM spoiled) r, (SELECT count(*) AS n FROM uniq_spoiled) u,
             (SELECT count(*) AS n, count(DISTINCT (date, hour)) AS p FROM clean_spoiled) c""",
    "incremental_window": f"""
        SELECT {TICK_COLS} FROM live, clock
        WHERE crawl_ts > t - INTERVAL 8 DAYS AND crawl_ts <= t - INTERVAL 1 DAY""",
    "fn_calendar": """
        SELECT o_orderkey, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS date, CAST(hour(o_orderdate) AS INT) AS hour,
               CAST(dayofweek(o_orderdate) + 1 AS INT) AS day_of_week, CAST(week(o_orderdate) AS INT) AS week_of_year,
               CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS year,
               CAST(day(o_orderdate) AS INT) AS day
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS o_orderdate FROM orders)""",
    "scan_date_range": """
        SELECT coin_id, crawl_ts, date, current_price, total_volume FROM clean, clock
        WHERE date BETWEEN d - 10 AND d - 3""",
    "raw_partition_route": """
        SELECT * FROM (
            SELECT coin_id, last_updated,
                   CASE WHEN total_volume % 3 = 0 THEN '2023-12-31' WHEN total_volume % 7 = 0 OR total_volume % 11 = 0 THEN NULL
                        ELSE strftime(last_updated, '%Y-%m-%d') END AS dt,
                   CASE WHEN total_volume % 7 <> 0 AND total_volume % 11 <> 0 THEN strftime(last_updated, '%H')
                        WHEN total_volume % 3 = 0 THEN '00' END AS hr
            FROM ticks) WHERE dt IS NOT NULL AND hr IS NOT NULL""",
    "affected_partitions": "SELECT DISTINCT date, hour FROM clean",
    "records_per_date": "SELECT date, count(*) AS records FROM clean GROUP BY date",
    "date_bounds": "SELECT min(date) AS min_date, max(date) AS max_date FROM clean",
    # parsing
    "parse_json": "SELECT event_id, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM events",
    "normalize_payload": """
        SELECT '2024-01-01T00:00:00' AS crawl_time, 'coingecko' AS source, concat('part-', p_partkey) AS coin_id,
               upper(p_brand) AS symbol, p_name AS name, p_retailprice AS current_price, p_partkey + 1 AS market_cap,
               p_size AS market_cap_rank,
               CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size - 25 AS DOUBLE) END AS price_change_percentage_1h
        FROM part""",
    "alert_json": """
        SELECT coin_id AS key, 'price_alert' AS alert_category, alert_type, coin_id, symbol, name, current_price,
               price_change_percentage_1h AS change_1h, price_change_percentage_24h AS change_24h, total_volume,
               date_trunc('milliseconds', crawl_ts) AS alert_time FROM alerted""",
    # rollups
    "daily_ohlc": "SELECT * FROM ohlc",
    "daily_metrics": "SELECT * FROM daily",
    "merged_states": "SELECT * FROM daily",
    "daily_ranks": """
        SELECT coin_id, date, open_price, close_price, rank_open, rank_close, rank_change FROM daily""",
    "day_sequence": """
        SELECT coin_id, date, count(*) AS ticks, min(crawl_ts) AS first_ts, max(crawl_ts) AS last_ts,
               arg_min(current_price, crawl_ts) AS first_price, arg_max(current_price, crawl_ts) AS last_price
        FROM clean GROUP BY coin_id, date""",
    "weekly_metrics": "SELECT * FROM weekly",
    "monthly_metrics": "SELECT * FROM monthly",
    "affected_weeks": """
        SELECT * FROM weekly WHERE (year, week_of_year) IN (
            SELECT (year, week_of_year) FROM daily, clock WHERE date >= d - 3)""",
    "affected_months": """
        SELECT * FROM monthly WHERE (year, month) IN (SELECT (year, month) FROM daily, clock WHERE date >= d - 3)""",
    **{f"{name}_avg": f"""
        SELECT *, (c - o) / o * 100 AS price_change_pct, (max_price - min_price) / o * 100 AS volatility FROM (
            SELECT year, {part}, coin_id, symbol, name, round(avg(close_price), 6) AS avg_price,
                   max(high_price) AS max_price, min(low_price) AS min_price,
                   CAST(sum(volume_sum_day) AS BIGINT) AS total_volume,
                   round(avg(volume_sum_day), 6) AS avg_daily_volume,
                   arg_min(open_price, date) AS o, arg_max(close_price, date) AS c FROM daily GROUP BY ALL)
        """ for name, part in (("weekly", "week_of_year"), ("monthly", "month"))},
    "orders_weekly": rollup_sql("orders_daily", "year", "week_of_year", "week"),
    "orders_weekly_iso": rollup_sql("orders_daily", "CAST(isoyear(date) AS INT)", "week_of_year", "week"),
    "orders_monthly": rollup_sql("orders_daily", "year", "month", "month"),
    # newest period, snapshot, history
    "latest_daily": """
        SELECT date, coin_id, symbol, name, open_price, close_price, high_price, low_price, return_pct_day,
               volatility_day, volume_sum_day, market_cap_close, rank_close
        FROM daily WHERE date = (SELECT max(date) FROM daily) ORDER BY return_pct_day DESC, coin_id LIMIT 100""",
    "latest_weekly": """
        SELECT year, week_of_year, week_start_date, week_end_date, coin_id, symbol, name, open_price_week,
               close_price_week, high_price_week, low_price_week, return_pct_week, volatility_week, volume_sum_week
        FROM weekly WHERE year * 100 + week_of_year = (SELECT max(year * 100 + week_of_year) FROM weekly)
        ORDER BY return_pct_week DESC, coin_id LIMIT 100""",
    "latest_monthly": """
        SELECT year, month, month_start_date, month_end_date, coin_id, symbol, name, open_price_month,
               close_price_month, high_price_month, low_price_month, return_pct_month, volatility_month, volume_sum_month
        FROM monthly WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM monthly)
        ORDER BY return_pct_month DESC, coin_id LIMIT 100""",
    "latest_snapshot": "SELECT * FROM latest",
    "history_table": "SELECT * FROM history",
    "latest_page": "SELECT * FROM latest ORDER BY rank, symbol LIMIT 5 OFFSET 5",
    "coin_detail": "SELECT * FROM latest WHERE symbol = 'C3'",
    # alerts
    "price_alerts": """
        SELECT coin_id, crawl_ts, alert_type, current_price, price_change_percentage_1h, price_change_percentage_24h
        FROM alerted""",
    "valid_alerts": """
        SELECT coin_id, alert_type, crawl_ts AS alert_time, total_volume FROM alerted
        WHERE total_volume % 10 <> 0 AND total_volume % 7 <> 0""",
    "recent_alerts": """
        SELECT * FROM alert_store WHERE alert_type = 'PUMP_24H' AND severity = 'LOW'
        ORDER BY detected_at DESC, symbol LIMIT 50""",
    "alerts_total": "SELECT count(*) AS total_count FROM recent_store",
    "alerts_by_type": """
        SELECT alert_type, count(*) AS alerts FROM recent_store GROUP BY 1 ORDER BY alerts DESC, 1 LIMIT 20""",
    "sketch_top_symbols": """
        SELECT symbol, count(*) AS alerts FROM recent_store WHERE symbol IS NOT NULL GROUP BY 1 ORDER BY alerts DESC, 1 LIMIT 10""",
    "alerts_by_severity": """
        SELECT severity, count(*) AS alerts FROM recent_store WHERE severity IS NOT NULL
        GROUP BY 1 ORDER BY alerts DESC, 1 LIMIT 10""",
    **{name: f"""
        SELECT CAST(a.date AS DATE) AS date, coalesce(r.n, 0) AS alerts
        FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM {days}) a
        LEFT JOIN {days} r ON CAST(a.date AS DATE) = r.date""" for name, days in (("alerts_by_day", "all_days"), ("alerts_by_day_gaps", "rare_days"))},
    "recent_alerts_all": "SELECT * FROM alert_store ORDER BY detected_at DESC, symbol, alert_type, name LIMIT 1000",
    "volume_spikes": """
        SELECT * FROM alert_store WHERE alert_type IN ('whale_alert', 'WHALE_ALERT') OR alert_type LIKE '%volume%'
        ORDER BY detected_at DESC, symbol LIMIT 100""",
    "alert_counts": """
        SELECT CAST(detected_at AS DATE) AS date, alert_type, count(*) AS alerts FROM alert_store GROUP BY ALL""",
    "alerts_recent_by_coin": """
        SELECT symbol, count(*) AS alerts FROM alert_store, clock
        WHERE alert_type = 'PUMP_1H' AND detected_at >= t - INTERVAL 1 HOUR GROUP BY symbol""",
    "stream_whale_days": """
        WITH d AS (SELECT coin_id, symbol, name, CAST(crawl_ts AS DATE) AS date, arg_min(current_price, crawl_ts) AS o,
                          arg_max(current_price, crawl_ts) AS close_price, arg_max(total_volume, crawl_ts) AS current_volume
                   FROM live WHERE current_price > 0 AND market_cap > 0 AND total_volume >= 0 GROUP BY ALL),
        w AS (SELECT *, avg(current_volume) OVER (PARTITION BY coin_id ORDER BY date
                        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS normal FROM d)
        SELECT coin_id, symbol, name, date, current_volume, round(normal, 6) AS normal_volume,
               round(current_volume / normal * 100, 6) AS volume_spike_pct,
               CASE WHEN o <> 0 THEN (close_price - o) / o * 100 END AS return_pct_day, close_price
        FROM w, clock WHERE current_volume / normal * 100 > 200 AND CAST(date AS TIMESTAMP) + INTERVAL 1441 MINUTES <= t""",
    "stream_unique": """
        SELECT coin_id, CAST(crawl_ts AS DATE) AS date, count(DISTINCT crawl_ts) AS ticks FROM live GROUP BY ALL""",
    "whale_detection": """
        SELECT coin_id, symbol, name, date, volume_sum_day AS current_volume, round(normal_volume, 6) AS normal_volume,
               round(spike, 6) AS volume_spike_pct, return_pct_day, close_price FROM whales""",
    "pump_dump_batch": "SELECT * FROM pumps",
    "pump_dump_list": """
        SELECT *, (SELECT count(*) FROM pumps WHERE type = 'PUMP') AS total_pumps,
               (SELECT count(*) FROM pumps WHERE type = 'DUMP') AS total_dumps
        FROM pumps WHERE type = 'PUMP' ORDER BY abs(price_change_pct) DESC, coin_id, date LIMIT 50""",
    # sentiment
    "sentiment_1m": "SELECT * FROM mood_live",
    "latest_prices_1m": """
        SELECT coin_id, symbol, name, arg_max(current_price, crawl_ts) AS latest_price,
               arg_max(price_change_percentage_24h, crawl_ts) AS change_24h,
               arg_max(market_cap_rank, crawl_ts) AS rank, arg_max(total_volume, crawl_ts) AS volume,
               max(crawl_ts) AS last_update
        FROM live GROUP BY coin_id, symbol, name, date_trunc('minute', crawl_ts)""",
    "sentiment_daily": mood("daily", "date", "date", "return_pct_day", "avg_return_pct"),
    # market
    "market_summary": f"""
        SELECT *, CASE WHEN gainers_count > losers_count THEN 'BULLISH' ELSE 'BEARISH' END AS market_sentiment,
               {money('total_market_cap')} AS market_cap_label, {money('total_volume_24h')} AS volume_label
        FROM (SELECT CAST(sum(market_cap) AS BIGINT) AS total_market_cap, CAST(sum(volume_24h) AS BIGINT) AS total_volume_24h,
                     count(symbol) AS coin_count, round(avg(percent_change_24h), 2) AS avg_change_24h,
                     count(*) FILTER (WHERE percent_change_24h > 0) AS gainers_count,
                     count(*) FILTER (WHERE percent_change_24h < 0) AS losers_count FROM latest)""",
    "cap_distribution": f"""
        SELECT t.tier, count(l.symbol) AS coins, CAST(coalesce(sum(l.market_cap), 0) AS BIGINT) AS total_market_cap
        FROM (VALUES ('large_cap'), ('mid_cap'), ('small_cap')) t(tier)
        LEFT JOIN (SELECT *, {tier('market_cap')} AS tier FROM latest) l ON l.tier = t.tier GROUP BY t.tier""",
    "cap_distribution_daily": f"""
        SELECT date, {tier('market_cap_close')} AS tier, count(*) AS coins,
               CAST(sum(market_cap_close) AS BIGINT) AS total_market_cap FROM daily GROUP BY ALL""",
    "dominance": f"""
        SELECT date, CAST(sum(market_cap_close) AS BIGINT) AS total_market_cap, {share('coin-0')} AS base_dominance,
               {share('coin-1')} AS second_dominance FROM daily GROUP BY date""",
    "market_daily": f"""
        SELECT date, CAST(sum(market_cap_close) AS BIGINT) AS total_market_cap,
               CAST(sum(volume_sum_day) AS BIGINT) AS total_volume, {share('coin-0')} AS base_dominance,
               round(avg(return_pct_day), 6) AS avg_change, count(*) FILTER (WHERE return_pct_day > 0) AS bullish_count,
               count(*) FILTER (WHERE return_pct_day < 0) AS bearish_count FROM daily GROUP BY date""",
    "hourly_volume": """
        SELECT date, hour, CAST(sum(v) AS BIGINT) AS total_volume, count(*) AS coins
        FROM (SELECT date, hour, coin_id, arg_max(total_volume, crawl_ts) AS v FROM clean GROUP BY ALL) GROUP BY ALL""",
    "base_correlation": """
        SELECT a.coin_id, round(corr(a.return_pct_day, b.return_pct_day), 6) AS correlation, count(*) AS days
        FROM daily a JOIN daily b ON a.date = b.date AND b.coin_id = 'coin-0'
        WHERE a.coin_id <> 'coin-0' GROUP BY a.coin_id HAVING count(*) >= 3""",
    "volume_price_corr": """
        SELECT coin_id, round(corr(volume_sum_day, close_price), 6) AS correlation, count(*) AS days
        FROM daily GROUP BY coin_id HAVING count(*) >= 3""",
    "rank_changes": """
        SELECT coin_id, symbol, date, rank_close, p AS previous_rank, p - rank_close AS rank_move
        FROM (SELECT *, lag(rank_close) OVER (PARTITION BY coin_id ORDER BY date) AS p FROM daily)""",
    "top_movers": movers_sql("newest", "daily", 20),
    "orders_movers": movers_sql("newest_orders", "orders_closes", 30),
    "top_coin_trends": trend_sql("""(
        SELECT h.* FROM history h, clock WHERE h.date >= d - 7
          AND h.symbol IN (SELECT symbol FROM latest ORDER BY market_cap DESC, symbol LIMIT 10))"""),
    "price_heatmap": """
        SELECT symbol, date, round(avg(return_pct_day), 6) AS return_pct FROM daily GROUP BY ALL""",
    "performance_compare": """
        SELECT d.coin_id, d.symbol, d.name, d.date, d.return_pct_day, w.return_pct_week, m.return_pct_month
        FROM daily d
        JOIN (SELECT coin_id, max(date) AS date FROM daily GROUP BY coin_id) n ON n.coin_id = d.coin_id AND n.date = d.date
        LEFT JOIN weekly w ON w.coin_id = d.coin_id AND w.year = d.year AND w.week_of_year = d.week_of_year
        LEFT JOIN monthly m ON m.coin_id = d.coin_id AND m.year = d.year AND m.month = d.month""",
    "most_volatile": """
        SELECT coin_id, symbol, date, volatility_day, market_cap_rank_close FROM daily, clock
        WHERE date = d - 1 ORDER BY volatility_day DESC, market_cap_rank_close, coin_id LIMIT 10""",
    # serving
    "price_history": "SELECT h.* FROM history h, clock WHERE symbol = 'C0' AND date >= d - 7 ORDER BY date LIMIT 1000",
    "price_trend": trend_sql("(SELECT h.* FROM history h, clock WHERE symbol = 'C0' AND date >= d - 7)"),
    "price_trend_long": trend_sql("""(SELECT symbol, date, close_price AS price_usd FROM orders_daily
        WHERE symbol = '1-URGENT' AND date >= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - 4000)""").replace("7 AS period_days", "4000 AS period_days"),
    "history_interval": " UNION ALL ".join(f"""
        SELECT coin_id, CAST(date_trunc('{unit}', crawl_ts) AS TIMESTAMP) AS timestamp,
               arg_max(current_price, crawl_ts) AS price, arg_max(total_volume, crawl_ts) AS volume,
               arg_max(market_cap, crawl_ts) AS market_cap, '{label}' AS interval
        FROM clean, clock WHERE coin_id = 'coin-0' AND date >= d - 7 GROUP BY ALL
        """ for unit, label in (("hour", "hourly"), ("day", "daily"))),
    "top_gainers": """
        SELECT symbol, name, price_usd, percent_change_24h, volume_24h FROM latest WHERE percent_change_24h > 0
        ORDER BY percent_change_24h DESC, symbol LIMIT 10""",
    "top_losers": """
        SELECT symbol, name, price_usd, percent_change_24h, volume_24h FROM latest WHERE percent_change_24h < 0
        ORDER BY percent_change_24h, symbol LIMIT 10""",
    "cap_ranking": """
        SELECT symbol, name, market_cap, price_usd, rank, volume_24h,
               CAST(row_number() OVER (ORDER BY market_cap DESC, symbol) AS INT) AS current_rank
        FROM latest ORDER BY market_cap DESC, symbol LIMIT 20""",
    "filter_coins": """
        SELECT * FROM latest WHERE market_cap >= 1000000 AND price_usd BETWEEN 1 AND 200 AND percent_change_24h <= 0
        ORDER BY market_cap DESC, symbol LIMIT 50""",
    "search_coin": """
        SELECT p_partkey, p_name, p_brand, CAST(dist AS INT) AS distance FROM (
            SELECT *, list_min(list_filter(list_transform(string_split(lower(p_name), ' '), lambda w: levenshtein(w, 'gizmp')),
                                           lambda x: x <= 1)) AS dist FROM part)
        WHERE dist IS NOT NULL OR lower(p_name) LIKE '%gizmp%' OR p_brand LIKE '%GIZMP%'
        ORDER BY dist NULLS LAST, p_retailprice DESC, p_partkey LIMIT 20""",
    "fuzzy_keywords": """
        WITH p AS (SELECT p_partkey, lower(split_part(p_name, ' ', 1)) AS w, list_distinct(regexp_split_to_array(lower(p_name), '[^a-z0-9]+')) AS words FROM part),
        k AS (SELECT DISTINCT substr(w, 1, CAST(p_partkey % length(w) AS INT)) || CASE WHEN p_partkey % 2 = 0 THEN 'q' ELSE '' END
                     || substr(w, CAST(p_partkey % length(w) AS INT) + 2) AS keyword FROM p),
        m AS (SELECT keyword, p_partkey, min(levenshtein(keyword, x.word)) AS distance FROM (SELECT p_partkey, unnest(words) AS word FROM p) x, k
              WHERE length(keyword) > 0 AND levenshtein(keyword, x.word) <= CASE WHEN length(keyword) <= 2 THEN 0 WHEN length(keyword) <= 5 THEN 1 ELSE 2 END
              GROUP BY ALL)
        SELECT keyword, CAST(distance AS INT) AS distance, count(*) AS parts FROM m GROUP BY ALL""",
    "rolling_range": "SELECT coin_id, date, close_price FROM daily, clock WHERE date BETWEEN d - 7 AND d",
    "kql_filters": """
        SELECT symbol, date, market_cap_close, volume_sum_day, volatility_day, return_pct_day FROM daily
        WHERE volume_sum_day > 200000 AND volatility_day > 15 AND market_cap_close BETWEEN 1000000 AND 500000000
          AND symbol IN ('C0', 'C1', 'C3', 'C4', 'C5', 'C6')""",
    "kql_filter_cases": " UNION ALL ".join(f"""
        SELECT '{name}' AS filter, symbol, date, market_cap_close, volume_sum_day, volatility_day, return_pct_day FROM daily WHERE {where}
        """ for name, where in KQL_WHERE.items()),
    "kql_alert_filters": """
        SELECT * FROM alert_store WHERE alert_type IN ('PUMP_1H', 'DUMP_24H') AND symbol IN ('C1', 'C5')""",
    "movers_table": """
        SELECT CAST(row_number() OVER (ORDER BY abs(return_pct_day) DESC, coin_id) AS INT) AS position, coin_id, symbol,
               name, open_price, close_price, high_price, low_price, return_pct_day, volatility_day, volume_sum_day,
               'negative' AS direction
        FROM daily, clock WHERE date = d - 1 AND return_pct_day < 0 ORDER BY abs(return_pct_day) DESC, coin_id LIMIT 20""",
    "movers_gainers": """
        SELECT CAST(row_number() OVER (ORDER BY return_pct_day DESC, coin_id) AS INT) AS position, coin_id, symbol,
               name, open_price, close_price, high_price, low_price, return_pct_day, volatility_day, volume_sum_day,
               'positive' AS direction
        FROM daily, clock WHERE date = d - 1 AND return_pct_day > 0 ORDER BY return_pct_day DESC, coin_id LIMIT 20""",
    "summary_cards": weekly_cards_sql(),
    "summary_cards_daily": cards_sql("daily", "day"),
    "chart_top_volume": """
        SELECT coin_id, symbol, name, return_pct_month, volume_sum_month FROM monthly
        ORDER BY volume_sum_month DESC, coin_id LIMIT 10""",
    # panels
    "panel_price_trend": """
        SELECT date, symbol, round(avg(close_price), 6) AS avg_close FROM daily, clock
        WHERE date BETWEEN d - 20 AND d AND symbol IN ('C0', 'C1', 'C2', 'C3', 'C4') GROUP BY date, symbol""",
    "panel_volume_heatmap": """
        SELECT date, symbol, CAST(sum(volume_sum_day) AS BIGINT) AS volume FROM daily, clock
        WHERE date BETWEEN d - 20 AND d AND symbol IN (
            SELECT symbol FROM daily, clock WHERE date BETWEEN d - 20 AND d
            GROUP BY symbol ORDER BY sum(volume_sum_day) DESC, symbol LIMIT 10) GROUP BY date, symbol""",
    "panel_weekly_perf": """
        SELECT symbol, round(a, 6) AS avg_return, CASE WHEN a >= 0 THEN 'green' ELSE 'red' END AS colour
        FROM (SELECT symbol, avg(return_pct_week) AS a FROM weekly, clock
              WHERE week_start_date BETWEEN d - 14 AND d GROUP BY symbol) ORDER BY a DESC, symbol LIMIT 10""",
    "panel_monthly_trend": """
        SELECT CAST(date_trunc('month', month_start_date) AS DATE) AS month_start, symbol,
               round(avg(close_price_month), 6) AS avg_close
        FROM monthly, clock WHERE month_start_date BETWEEN d - 365 AND d AND symbol IN ('C0', 'C1', 'C2', 'C3', 'C4') GROUP BY ALL""",
    "panel_alert_types": """
        SELECT alert_type, count(*) AS alerts FROM alerted GROUP BY 1 ORDER BY alerts DESC, 1 LIMIT 10""",
    "panel_alert_coins": """
        SELECT *, CASE WHEN change_1h > 5 THEN 'UP' WHEN change_1h < -5 THEN 'DOWN' ELSE 'FLAT' END AS band_1h,
               CASE WHEN change_24h > 10 THEN 'UP' WHEN change_24h < -10 THEN 'DOWN' ELSE 'FLAT' END AS band_24h
        FROM (SELECT symbol, alert_type, count(*) AS alerts, arg_max(current_price, crawl_ts) AS latest_price,
                     arg_max(price_change_percentage_1h, crawl_ts) AS change_1h,
                     arg_max(price_change_percentage_24h, crawl_ts) AS change_24h, max(crawl_ts) AS alert_time
              FROM alerted WHERE symbol IN (
                  SELECT symbol FROM alerted GROUP BY symbol ORDER BY max(crawl_ts) DESC, symbol LIMIT 15)
              GROUP BY symbol, alert_type)""",
    "panel_sentiment_series": """
        SELECT CAST(date_trunc('hour', window_start) AS TIMESTAMP) AS time, round(avg(bullish_pct), 6) AS bullish_pct,
               round(avg(bearish_pct), 6) AS bearish_pct, 60 AS bullish_line, 40 AS bearish_line
        FROM mood_live GROUP BY 1""",
    "panel_sentiment_now": """
        SELECT window_start, sentiment, bullish_pct, bearish_pct, avg_change_24h,
               round(100 - bullish_pct - bearish_pct, 2) AS neutral_pct,
               CASE WHEN bullish_pct < 30 THEN 'Strong Bearish' WHEN bullish_pct < 45 THEN 'Bearish'
                    WHEN bullish_pct < 55 THEN 'Neutral' WHEN bullish_pct < 70 THEN 'Bullish' ELSE 'Strong Bullish' END AS gauge,
               CASE WHEN bullish_pct < 40 THEN 'Red' WHEN bullish_pct <= 60 THEN 'Yellow' ELSE 'Green' END AS light
        FROM mood_live ORDER BY window_start DESC LIMIT 1""",
    # export and merge
    "export_daily": f"""
        SELECT strftime(date, {ISO}) AS "@timestamp", strftime(date, {ISO}) AS date,
               concat(coin_id, '_', strftime(date, {ISO})) AS doc_id, {DAILY_COLS} FROM daily""",
    "export_weekly": f"""
        SELECT * REPLACE (strftime(week_start_date, {ISO}) AS week_start_date, strftime(week_end_date, {ISO}) AS week_end_date),
               strftime(week_start_date, {ISO}) AS "@timestamp", concat(coin_id, '_', year, '_', week_of_year) AS doc_id
        FROM weekly""",
    "export_monthly": f"""
        SELECT * REPLACE (strftime(month_start_date, {ISO}) AS month_start_date, strftime(month_end_date, {ISO}) AS month_end_date),
               strftime(month_start_date, {ISO}) AS "@timestamp",
               concat(coin_id, '_', strftime(month_start_date, {ISO})) AS doc_id FROM monthly""",
    "export_relational": f"SELECT strftime(date, '%Y-%m-%d') AS date, {DAILY_COLS} FROM daily",
    "realtime_doc_id": """
        SELECT last_updated, CASE WHEN market_cap_rank % 3 = 0 THEN ts
               WHEN market_cap_rank % 3 = 1 THEN concat(coin, '_', ts)
               ELSE concat(coin, '_', CASE WHEN total_volume % 2 = 0 THEN ts ELSE '' END) END AS doc_id
        FROM (SELECT last_updated, market_cap_rank, total_volume, strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS ts,
                     CASE WHEN total_volume % 5 <> 0 THEN coin_id ELSE 'unknown' END AS coin FROM ticks)""",
    "upsert_by_id": f"""
        SELECT concat(coin_id, '_', strftime(date, {ISO})) AS doc_id, coalesce(l.close_price, o.close_price) AS close_price,
               coalesce(l.volume_sum_day, o.volume_sum_day) AS volume_sum_day,
               CASE WHEN l.close_price IS NULL THEN 0 ELSE 1 END AS version
        FROM ohlc o FULL JOIN (SELECT x.* FROM ohlc_live x, clock WHERE date >= d - 3) l USING (coin_id, date)""",
    "lambda_merge": """
        WITH b AS (SELECT coin_id, date, close_price, record_count FROM ohlc, clock WHERE date < d - 3)
        SELECT *, 'batch' AS layer FROM b
        UNION ALL
        SELECT l.coin_id, l.date, l.close_price, l.record_count, 'realtime' FROM ohlc_live l
        WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.coin_id = l.coin_id AND b.date = l.date)""",
    "forward_fill": """
        SELECT coin_id, crawl_ts, last_value(p IGNORE NULLS) OVER (PARTITION BY coin_id ORDER BY crawl_ts
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS current_price
        FROM (SELECT coin_id, crawl_ts, CASE WHEN total_volume % 3 <> 0 THEN current_price END AS p FROM live)""",
    "retention_filter": "SELECT coin_id, crawl_ts, date, current_price FROM clean, clock WHERE date >= d - 7",
    "unprocessed_dates": "SELECT DISTINCT date FROM clean, clock WHERE date >= d - 7",
}

VIEWS["newest"] = """
    SELECT coin_id, symbol, max(crawl_ts) AS ts, CAST(max(crawl_ts) AS DATE) AS d, arg_max(current_price, crawl_ts) AS price,
           arg_max(total_volume, crawl_ts) AS volume, arg_max(price_change_percentage_24h, crawl_ts) AS c24,
           arg_max(price_change_percentage_7d, crawl_ts) AS c7 FROM clean GROUP BY coin_id, symbol"""
VIEWS["week3"] = "SELECT * FROM weekly WHERE year = 2024 AND week_of_year = 3"
VIEWS["order_moves"] = """
    SELECT o_orderpriority AS coin_id, o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
           o_orderdate + to_microseconds(o_orderkey) AS crawl_ts, o_totalprice AS current_price, o_custkey AS total_volume,
           CAST((o_orderkey * 37) % 401 - 200 AS DOUBLE) / 10 AS price_change_percentage_24h,
           CAST((o_orderkey * 53) % 551 - 250 AS DOUBLE) / 10 AS price_change_percentage_7d FROM orders"""
VIEWS["orders_closes"] = "SELECT coin_id, date, arg_max(current_price, crawl_ts) AS close_price FROM order_moves GROUP BY ALL"
VIEWS["newest_orders"] = """
    SELECT coin_id, symbol, max(crawl_ts) AS ts, CAST(max(crawl_ts) AS DATE) AS d, arg_max(current_price, crawl_ts) AS price,
           arg_max(total_volume, crawl_ts) AS volume, arg_max(price_change_percentage_24h, crawl_ts) AS c24,
           arg_max(price_change_percentage_7d, crawl_ts) AS c7 FROM order_moves GROUP BY coin_id, symbol"""

# Columns of a statement that only serve another column of it.
HELPERS = {"weekly_avg": "o, c", "monthly_avg": "o, c"}


def mentioned(sql: str) -> set[str]:
    """Names of the shared subqueries a text refers to, directly or through each other."""
    found = {name for name in VIEWS if re.search(rf"(FROM|JOIN|,)\s+{name}\b", sql)}
    for name in list(found):
        found |= mentioned(VIEWS[name])
    return found


def statement(body: str) -> str:
    needed = mentioned(body)
    # A subquery may be defined late but used by nothing earlier, so dependency depth gives the order.
    order = sorted(needed, key=lambda n: (len(mentioned(VIEWS[n])), n))
    parts = [f"{name} AS ({VIEWS[name]})" for name in order]
    if not parts:
        return body
    return f"WITH {', '.join(parts)} SELECT * FROM ({body})"


def statements() -> dict[str, str]:
    out = {}
    for name, body in SQL.items():
        if name in HELPERS:
            body = f"SELECT * EXCLUDE ({HELPERS[name]}) FROM ({body})"
        out[name] = statement(body)
    return out
