"""Helpers shared by the tests."""

import contextlib
import io


def same_rows(one, other):
    assert one.columns == other.columns
    assert one.exceptAll(other).count() == 0
    assert other.exceptAll(one).count() == 0


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
