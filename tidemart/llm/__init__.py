"""Operators for training-data preparation, one module each.

Functions that run in Python workers are pickled by value, so that executors
need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
