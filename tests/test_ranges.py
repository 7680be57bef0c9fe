import datetime as dt

from hypothesis import given
from hypothesis import strategies as st

from tickmart.plans import ranges

D = dt.date
dates = st.dates(D(2015, 1, 1), D(2030, 12, 31))


@given(dates, st.integers(0, 40))
def test_months_cover_every_day_of_the_weeks(start, length):
    weeks = sorted({ranges.week_key(d) for d in ranges.days_of(start, start + length * ranges.DAY)})
    months = set(ranges.months_of_weeks(weeks))
    for year in {y for y, _ in weeks}:
        for day in ranges.days_of(D(year, 1, 1), D(year, 12, 31)):
            if ranges.week_key(day) in weeks:
                assert (day.year, day.month) in months


def test_year_end_week_reaches_both_ends_of_the_year():
    assert ranges.months_of_weeks([(2025, 1)]) == [(2025, 1), (2025, 12)]


def test_pairs(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 2), (2025, 1), (2025, 3)], "y int, m int")
    got = df.where(ranges.in_pairs("y", "m", [(2024, 2), (2025, 1)])).collect()
    assert sorted(map(tuple, got)) == [(2024, 2), (2025, 1)]
    assert df.where(ranges.in_pairs("y", "m", [])).isEmpty()
