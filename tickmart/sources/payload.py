"""The price API's answer, a JSON array of coin objects, as raw tick rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.schemas import PAYLOAD_DDL

# Answer field -> tick field, where the names differ.
RENAMES = {
    "id": "coin_id",
    "image": "image_url",
    "price_change_percentage_1h_in_currency": "price_change_percentage_1h",
    "price_change_percentage_7d_in_currency": "price_change_percentage_7d",
}


def normalize_payload(answers: DataFrame, column: str, crawl_time: Column | str,
                      source: str = "coingecko") -> DataFrame:
    """One row per coin object of each answer. Missing fields are null, the symbol is upper-cased."""
    stamp = F.col(crawl_time) if isinstance(crawl_time, str) else crawl_time
    schema = f"array<struct<{', '.join(f'{n}: {t}' for n, t in payload_fields())}>>"
    coins = answers.select(stamp.alias("crawl_time"), F.inline(F.from_json(column, schema)))
    named = [F.coalesce(F.upper("symbol"), F.lit("")).alias("symbol") if n == "symbol"
             else F.col(n).alias(RENAMES.get(n, n)) for n, _ in payload_fields()]
    return coins.select("crawl_time", F.lit(source).alias("source"), *named)


def payload_fields() -> list[tuple[str, str]]:
    return [tuple(field.split()) for field in PAYLOAD_DDL.split(",")]


def message_key(coin_id: str = "coin_id") -> Column:
    """Key of a tick in the message log."""
    return F.concat(F.lit("crypto_"), F.col(coin_id))
