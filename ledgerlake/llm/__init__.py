"""Operators for large text corpora; each one is a DataFrame-in, DataFrame-out function.

The modules travel with the tasks, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
