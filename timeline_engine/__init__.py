"""A PySpark-native engine for temporal observation data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value: workers need not have
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
