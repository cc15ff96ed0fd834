"""Small literal frames and plan texts."""

from __future__ import annotations

import contextlib
import datetime as dt
import io


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df, executed=False) -> str:
    """The physical plan as printed by ``explain``."""
    if executed:
        df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
