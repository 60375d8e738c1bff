"""What tests share, under a name of its own."""

SMALL = "/root/testdata/sf0.001"


def values(df, *columns):
    """Rows as sorted tuples, nulls first."""
    rows = [tuple(row) for row in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: [(value is not None, str(type(value)), value) for value in row])
