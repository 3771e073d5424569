"""Operators for training-data pipelines: each module holds one operator; ``queries`` registers them.

Functions of this package travel to the Python workers by value, so executors
need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
