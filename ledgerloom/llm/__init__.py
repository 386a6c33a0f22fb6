"""Operators for training-data pipelines over tables of texts and vectors.

Functions of this package are sent to executors by value, so the package need
not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
