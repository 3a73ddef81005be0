"""Readers, writers and input views."""

import sys

from pyspark import cloudpickle

# The function that puts records together travels to the executors with its job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
