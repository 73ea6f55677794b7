def as_rows(df):
    """Rows with the columns in order of name."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
