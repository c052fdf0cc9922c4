"""Operators of a training-data pipeline over tables of documents.

Their functions travel to the executors by value, so that only Spark and the
Python libraries need to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
