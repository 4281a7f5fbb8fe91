"""Operators for preparing language-model training text."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this folder by value, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
