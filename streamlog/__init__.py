"""Record logs as Spark tables: subscriptions, offsets, envelopes and delivery."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors do not need
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
