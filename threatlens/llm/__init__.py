"""Operators for training-data pipelines.

Functions of this package that run inside tasks are sent to the executors by value, so
that these need only the public libraries, not the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
