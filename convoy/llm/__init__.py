"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, wherever the driver found them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
