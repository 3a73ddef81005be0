"""Operators that prepare training text: filter, deduplicate, mix, format, shard and pack documents."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the jobs that use them, so the package need not
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
