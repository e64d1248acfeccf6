"""Operators for preparing training text. Nothing outside this package (and the top-level pipeline) imports it."""
import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need not have this repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
