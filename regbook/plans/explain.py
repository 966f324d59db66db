"""Plan reports."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def plan_report(df: DataFrame, mode: str = "formatted") -> str:
    """The text of ``df.explain(mode)``."""
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()
