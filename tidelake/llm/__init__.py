"""Operators of a training-data pipeline.  Nothing else in the library imports this package.

Functions defined here are pickled by value, so tasks on other machines need no copy
of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
