"""churnlab: customer-churn analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers, writers and the ``customer_usage`` fixture built from the driver's tables
functions  column expressions (features, bins) and p-value helpers on aggregated rows
operators  cleaning, profiling, statistics, ordered prefix sums, sampling, models, attribution
plans      composed jobs: training, scoring, monitoring, retraining
streaming  Structured Streaming twins of scoring and monitoring
"""

__all__ = ["session"]
