"""Operators for training data: sharding, formatting, filtering, near copies, search, packing, mixing.

Functions that run in tasks travel to the executors whole, so the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
