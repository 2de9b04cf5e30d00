"""Physical plans as text."""

import contextlib
import io


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def tree(df):
    """Operator tree only, without the per-operator details."""
    return plan(df, "simple")
