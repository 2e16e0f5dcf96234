"""Operators for preparing training data: filters, near-duplicate detection, mixing, encoding."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
