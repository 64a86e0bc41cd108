"""Operators for preparing training text. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so workers need no installed package. What is broadcast
# is plain data, or packed with its class (common.shipped).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
