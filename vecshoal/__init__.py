"""Clustering and nearest-neighbour search over tables of embeddings, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
