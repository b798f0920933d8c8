"""Analytics operators as Spark DataFrame programs: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
