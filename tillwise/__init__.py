"""Retail retention analytics as PySpark DataFrame functions.

The layers, bottom up:

* ``functions`` - Column-returning helpers (calendar keys, money, rounding, line tests)
* ``operators`` - DataFrame -> DataFrame steps (lines, orders, customers, scores)
* ``plans``     - reports, KPIs and the table build put together from operators
* ``sources``   - raw CSV feed, stored tables, report files, sample-table adapter
"""

from tillwise.config import AnalyticsConfig

__all__ = ["AnalyticsConfig"]
