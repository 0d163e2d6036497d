"""Daily series per family: rollup, gaps filled, oil price interpolated."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelcast.operators.aggregates import daily_rollup
from panelcast.operators.windows import fill_calendar, interpolate

# Columns that are 0 on a day without rows.
ZERO_FILLED = ["sales", "onpromotion", "is_holiday"]


def daily_series(panel: DataFrame) -> DataFrame:
    """One row per family and calendar day."""
    daily = fill_calendar(daily_rollup(panel), ["family"], ZERO_FILLED)
    return interpolate(daily, "dcoilwtico", ["family"])
