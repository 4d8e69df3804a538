"""Operators from DataFrame to DataFrame."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers go to them by value, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
