import datetime as dt


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """Sorted tuples of the named (or all) columns."""
    out = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(out, key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
