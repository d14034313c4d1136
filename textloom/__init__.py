"""Corpus preparation and evaluation operators for PySpark.

Every operator is a ``DataFrame -> DataFrame`` function or a ``Column``
expression. See README.md for the list.
"""

import sys

from pyspark import cloudpickle

# Ship functions used inside tasks by value, so that executors need no copy of
# this package on their own Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
