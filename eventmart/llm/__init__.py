"""Operators for preparing training text at scale, and the queries that apply them.

Functions of this package travel to the executors by value, so a cluster needs no copy of it.
Nothing else in the library imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
