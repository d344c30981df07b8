"""Batch semantic search as ordinary Spark DataFrame work.

The Arrow functions in this package run inside Spark's Python workers.  They are
shipped by value, so an executor needs numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
