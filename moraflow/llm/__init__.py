"""Operators for training-data pipelines: deduplication, decontamination, filtering, search and tokenisation of texts."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions by value, so executors need no copy of it, only the libraries it uses.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
