"""Operators for preparing training text; nothing outside this subpackage imports it.

Functions that run inside Python workers are pickled by value, so executors
need no copy of this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
