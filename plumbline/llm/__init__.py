"""Operators for large training-data pipelines. Nothing else in the package imports this one.

Functions that run in Python workers are shipped by value, so executors need numpy and pyarrow
but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
