"""Operators of a training-data pipeline over documents and embeddings."""

import sys

from pyspark import cloudpickle

# executors need no copy of this package: tasks carry the functions they call
cloudpickle.register_pickle_by_value(sys.modules[__name__])
