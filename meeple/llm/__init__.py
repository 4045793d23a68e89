"""Operators of a training-data pipeline; nothing outside this subpackage imports it.

The functions that run inside Python tasks are shipped by value, so that workers
need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
