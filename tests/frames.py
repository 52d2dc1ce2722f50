"""What the tests of every operator share."""


def rows(df, *columns):
    """Rows as plain tuples, sorted by their text."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
