"""wattlake: Spark-native demand and weather analytics.

Keyed time series ``(time, region_id)`` flow bronze -> silver -> gold as
DataFrame plans; features, forecast evaluation, data quality and a
Structured Streaming refresh are built on the same operators.
"""

__version__ = "0.1.0"
