"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Functions that run inside tasks are sent to the executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
