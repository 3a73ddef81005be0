"""Reusable table operators: cleaning, quality checks, sampling, text, evaluation, learning."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel to the executors with their jobs, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
