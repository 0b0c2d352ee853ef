"""tessera: pixel, matrix and timing-table operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions handed to Python workers (mapInPandas bodies) are shipped by
# value, so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])
