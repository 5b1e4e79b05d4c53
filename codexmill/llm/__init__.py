"""Operators of a training-data pipeline: mixing, chat rendering, language identification,
fingerprints, set joins, substring dedup, quality, decontamination, licences, toxicity.

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so that they needn't have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
