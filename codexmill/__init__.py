"""codexmill: batch analytics over text-heavy archives, written for Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so that they needn't have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
