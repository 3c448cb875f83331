"""Operators that prepare a text corpus for training. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value: a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
