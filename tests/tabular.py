"""What several test modules share."""


def rows(df):
    """Rows as sorted tuples, NULLs included."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
