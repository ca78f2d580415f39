"""Operators for preparing training text, each by its own method, over the given tables.

The functions that run in Python workers are sent by value, so that an executor needs the same
libraries as the driver but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
