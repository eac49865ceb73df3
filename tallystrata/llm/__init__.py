"""Operators for training-data pipelines. Functions that run on executors travel by value, so a cluster needs no copy of this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
