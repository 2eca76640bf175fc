"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Python workers get these functions by value, so they need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
