"""Rows of a DataFrame in a form that tests compare."""


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
