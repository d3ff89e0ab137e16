"""Operators for preparing language-model training data (one module each), their queries and their SQL.

Functions of this package that run on executors are shipped by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
