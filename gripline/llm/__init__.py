"""Operators for training data."""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
