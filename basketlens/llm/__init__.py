"""Operators for preparing training text.

Functions of this package that run inside Spark tasks travel with the task, so
executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
