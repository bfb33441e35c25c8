"""Operators of a training-data pipeline; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Task code travels with the task: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
