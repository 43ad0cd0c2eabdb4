"""daybook: keyed daily-series analytics on Spark.

Load nested payloads incrementally, check quality, keep the newest version of
every (key, date), derive changes, extremes and biggest moves, and serve
dashboard datasets - all as DataFrame plans.
"""

from daybook.spec import SeriesSpec, Thresholds

__all__ = ["SeriesSpec", "Thresholds"]
__version__ = "0.1.0"
