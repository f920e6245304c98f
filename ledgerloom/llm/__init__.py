"""Training-data operators: each module is one operator, `queries` registers them over the given tables."""

import sys

from pyspark import cloudpickle

# Tasks get the operators' functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
