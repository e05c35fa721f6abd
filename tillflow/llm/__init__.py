"""Operators that prepare text for language models.

Functions of this package run inside Spark's Python workers.  They are pickled
by value, so executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
