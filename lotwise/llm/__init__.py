"""Operators for training-data pipelines; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so that workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
