"""Helpers of these tests: the small tables, and rows in an order that can be compared."""

SMALL = "/root/testdata/sf0.001"


def got(df, *columns):
    """Rows as sorted tuples, nulls first."""
    return ordered([tuple(r) for r in df.select(*columns).collect()])


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])
