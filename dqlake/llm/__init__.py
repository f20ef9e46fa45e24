"""Operators for building training data at scale. Nothing else in the library imports this subpackage.

Functions of this subpackage travel to the Python workers by value, so the cluster's machines need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
