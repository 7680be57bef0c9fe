"""Helpers of the tests; kept out of conftest.py, a name that the folders below use too."""


def rows(df, *columns):
    """Collected rows as plain tuples, sorted. Doubles keep 10 digits: averages depend on the order of addition."""
    def plain(v):
        return float(f"{v:.10g}") if isinstance(v, float) else v

    return sorted((tuple(map(plain, r)) for r in (df.select(*columns) if columns else df).collect()), key=repr)
