"""Text rendering of large numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit letters and their sizes.
UNITS = [("T", 1e12), ("B", 1e9), ("M", 1e6), ("K", 1e3)]
#: From here on doubles lie so far apart that hundredths are left to Java.
COARSE = 2.0 ** 45


def in_hundredths(value: Column) -> Column:
    """The double nearest to ``value`` rounded to two digits by its exact binary value, halves to even, as C and SQL print it.

    Java rounds the shortest decimal instead, so 1.005, which lies below the half, becomes 1.01. ``high`` and ``low`` are the
    halves of the value's digits (Veltkamp), so ``rest`` is exactly what ``value * 100`` lost.
    """
    size = F.abs(value)
    scaled = size * 100
    high = size * 134217729.0 - (size * 134217729.0 - size)
    rest = (high * 100 - scaled) + (size - high) * 100
    whole = F.floor(scaled).cast("double")
    over = scaled - whole
    up = (over > 0.5) | ((over == 0.5) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    rounded = (whole + up.cast("int")) / 100
    return F.when((size >= COARSE) | (value == 0), value).when(value < 0, -rounded).otherwise(rounded)


def human_number(value: Column, prefix: str = "$", units: str = "TBMK") -> Column:
    """``1234567`` -> ``$1.23M``. ``units`` picks the letters in use, largest first."""
    value = value.cast("double")
    ladder = None
    for letter, size in UNITS:
        if letter not in units:
            continue
        text = F.format_string(f"{prefix}%.2f{letter}", in_hundredths(value / size))
        ladder = (F if ladder is None else ladder).when(value >= size, text)
    plain = F.when(value.isNotNull(), F.format_string(f"{prefix}%.2f", in_hundredths(value)))
    return plain if ladder is None else ladder.otherwise(plain)
