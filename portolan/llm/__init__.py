"""Operators that prepare text, vectors and pages as training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so they need no installed copy there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
