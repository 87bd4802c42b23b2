"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions of this package that run inside Python tasks are pickled by value, so that executors need
no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
