"""Plans as text."""

from __future__ import annotations

import contextlib
import io


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()
