"""Operators of a training-data pipeline."""

import sys

from pyspark import cloudpickle

# Functions for executors travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
