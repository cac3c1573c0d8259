"""Operators for building training corpora, their queries and their oracles.

Functions of this package that run in tasks are sent to the executors by value,
so that a cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
