"""Business parameters shared by operators and reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class AnalyticsConfig:
    # The observation end and the thresholds of the published reports.
    as_of: date = date(2011, 12, 9)
    churn_days: int = 90
    repeat_days: int = 30
    days_per_month: float = 30.44
    max_month_offset: int = 11
