"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors whole; they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
