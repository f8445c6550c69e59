"""Operators for building training data: one module per operator, queries in ``registry``.

Functions of this package that run in Python workers are shipped by value, so
executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
