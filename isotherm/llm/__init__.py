"""Operators for training-data pipelines: formatting, tokenising, deduplication, classifiers, search, packing."""

import sys

from pyspark import cloudpickle

# Executors get the functions by value; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
