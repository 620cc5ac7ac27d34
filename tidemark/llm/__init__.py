"""Operators for preparing training text: formatting, mixing, filtering, archives, near-duplicates, packing."""

import sys

from pyspark import cloudpickle

# functions for Python workers travel whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
