"""Operators for training-data pipelines: deduplication, tokenising, sharding, filtering. Nothing outside imports them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
