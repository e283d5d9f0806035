"""Operators for preparing training data.

Python functions of this subpackage travel to the executors by value, so the
executors need the third-party libraries only, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
