"""veilframe: region-based visual anonymisation and its evaluation as Spark DataFrames."""

import sys

from pyspark import cloudpickle as _cloudpickle

# Functions sent to executors travel by value, so that workers need no copy of this package.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])
