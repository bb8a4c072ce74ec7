"""Operators for preparing language-model training data.

Functions of this package that run in Python on executors are shipped by value, so executors need
the installed third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
