"""Profiles of a cleaning run at the points where a reader wants to look.

Each point is one fused pass over its table (``operators.states``): the source as it came,
the standardised rows, and the rows that outlier removal leaves, whose gaps are not filled
yet. Curves and correlation of the last are passes of their own, since they need its limits.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame

from ..functions.columns import numeric_columns
from ..operators.distribution import correlation, density, histogram
from ..operators.states import profile_table
from .cleaning import FittedCleaning, survivors


def profile_run(source: DataFrame, fitted: FittedCleaning) -> dict[str, Callable[[], DataFrame]]:
    """Name of each profile -> function that computes it. Profiles of one point share a
    pass, which runs when the first of them is asked for."""

    lock = Lock()  # results are written by several threads

    def once(build: Callable):
        held = []

        def get():
            with lock:
                if not held:
                    held.append(build())
            return held[0]

        return get

    kept = survivors(fitted)
    numbers = numeric_columns(kept)
    raw = once(lambda: profile_table(source, numeric=()))
    standardised = once(lambda: profile_table(fitted.standardised, text=()))
    left = once(lambda: profile_table(kept, text=()))
    return {
        "raw_shape": lambda: raw().shape(),
        "raw_schema": lambda: raw().schema(),
        "raw_categories": lambda: raw().categories(),
        "standardised_summary": lambda: standardised().numeric_summary(),
        "kept_histogram": lambda: histogram(kept, known=left().extents()),
        "kept_density": lambda: density(kept, known=left().extents()),
        "kept_correlation": lambda: correlation(kept, numbers),
        "kept_missing": lambda: left().missing(),
    }
