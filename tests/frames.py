"""Small helpers for comparing frames with expected rows."""

import datetime as dt


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def when(text):
    return dt.datetime.fromisoformat(text)
