"""Comparison of small frames as sorted lists of tuples."""


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(x is None, str(x)) for x in t])


def same(df, expected, *columns):
    wanted = sorted(expected, key=lambda t: [(x is None, str(x)) for x in t])
    assert rows(df, *columns) == wanted


def plan(df):
    return df._jdf.queryExecution().toString()
