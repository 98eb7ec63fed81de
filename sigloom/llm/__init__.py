"""Operators that prepare text for training: filters, fingerprints, repeats, leaks, formats and mixes."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors themselves, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
