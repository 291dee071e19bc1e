"""cashcast: demand, billing and cash forecasting expressed as Spark DataFrame plans.

Every public operator is a function from DataFrame(s) to a DataFrame. Nothing is
collected to the driver except small summaries; per-series model fitting runs as
a grouped map on the executors.
"""

__version__ = "0.1.0"
