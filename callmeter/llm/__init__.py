"""Operators of a training-data pipeline: extraction, search, packing, archives, scoring and deduplication."""

import sys

from pyspark import cloudpickle

# The functions travel to the executors with the tasks that call them, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
