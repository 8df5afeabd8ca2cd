"""Operators for training-data pipelines.

Each module holds one operator with its own interface; ``registered`` holds the thin
queries over the test tables.  Nothing else in the package imports this one.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
