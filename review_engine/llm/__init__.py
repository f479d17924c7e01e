"""Operators for preparing language-model training data, and the queries that apply them.

Nothing else in the library imports this package. Functions that run in Python
workers are sent by value, so a worker needs the public libraries but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
