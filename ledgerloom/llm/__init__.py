"""Operators for training data: deduplication, packing, extraction, encoding, scoring, scans.

Nothing else in the library imports this package. Its functions are shipped to executors by
value, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
