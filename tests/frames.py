"""Helpers of the tests."""


def rows(df, *cols):
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
