"""Spark-native mail triage: decode, clean, embed, classify, trash and purge."""

import sys

from pyspark import cloudpickle

# Functions travel to the Python workers by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
