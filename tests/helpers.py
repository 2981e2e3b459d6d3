"""Helpers of the tests, apart from conftest.py, whose name other test folders use too."""


def rows(df, *cols):
    """Rows as a sorted list of tuples, or of values for a single column."""
    got = df.select(*cols).collect() if cols else df.collect()
    flat = [tuple(r) if len(r) > 1 else r[0] for r in got]
    return sorted(flat, key=lambda v: str(v))
