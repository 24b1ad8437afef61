"""Operators for preparing training text: filtering, near-duplicates, mixing, tokens, sharding.

Nothing else in the package imports this one. Functions that run on executors are
pickled by value, so that workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
