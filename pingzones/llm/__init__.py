"""Operators for training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the jobs: executors need no copy installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
