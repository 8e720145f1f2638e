"""Churn analytics expressed as Spark DataFrame, Spark SQL, Spark ML and streaming jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions sent to executors travel whole, so the package need not be installed there.
register_pickle_by_value(sys.modules[__name__])
