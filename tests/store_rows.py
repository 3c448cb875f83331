"""Shared by the tests of the store: where the tables are, rows for comparison."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as plain tuples, sorted for comparison."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
