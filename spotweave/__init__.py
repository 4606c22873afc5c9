"""Spark-native analytics for sequential-imaging spot tables."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
