"""History laid out along a space-filling curve over symbol and date, so that a lookup opens few files.

A year's rows lie in 256 cells, numbered by interleaving four bits of the symbol's hash with four bits of the day's place in
the year. The cell is a partition folder, so files are skipped by name: a symbol alone needs 16 cells of a year, a few weeks
alone 16 or 32, both together one or two.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 4
#: Days of a sixteenth of a year.
SPAN = 23


def _interleaved(symbol: Column, place: Column) -> Column:
    return sum(((F.shiftright(v, b).bitwiseAND(1) * (1 << (2 * b + side))) for b in range(BITS) for side, v in ((1, symbol), (0, place))), F.lit(0))


def symbol_bits(symbol: Column) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(1 << BITS)).cast("int")


def with_cells(history: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    place = F.expr(f"cast((dayofyear({date}) - 1) div {SPAN} as int)")
    return history.withColumns({"year": F.year(date), "cell": _interleaved(symbol_bits(F.col(symbol)), place).cast("int")})


def write_cells(history: DataFrame, path: str, symbol: str = "symbol", date: str = "date") -> None:
    laid = with_cells(history, symbol, date)
    laid.hint("rebalance", "year", "cell").sortWithinPartitions(symbol, date).write.mode("overwrite").partitionBy("year", "cell").parquet(path)


def _number(symbol: int, place: int) -> int:
    return sum((symbol >> b & 1) << (2 * b + 1) | (place >> b & 1) << (2 * b) for b in range(BITS))


def lookup(spark: SparkSession, path: str, symbol: str | None = None, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Rows of a symbol, of a range of days, or of both; only the cells that can hold them are opened."""
    rows = spark.read.parquet(path)
    if symbol is not None:
        rows = rows.where(F.col("symbol") == symbol)
    if since is not None:
        rows = rows.where((F.col("date") >= F.lit(since)) & (F.col("year") >= since.year))
    if until is not None:
        rows = rows.where((F.col("date") <= F.lit(until)) & (F.col("year") <= until.year))
    bits = range(1 << BITS) if symbol is None else [spark.range(1).select(symbol_bits(F.lit(symbol))).first()[0]]
    places = range(1 << BITS)
    if since is not None and until is not None and since.year == until.year:
        first, last = ((d.timetuple().tm_yday - 1) // SPAN for d in (since, until))
        places = range(first, last + 1)
    return rows.where(F.col("cell").isin(sorted(_number(s, p) for s in bits for p in places))).drop("year", "cell")
