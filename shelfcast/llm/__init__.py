"""Operators of a training-data pipeline over documents, vectors and conversations."""

import sys

from pyspark import cloudpickle

# executors get the functions of this package with their tasks; it needs no installation there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
