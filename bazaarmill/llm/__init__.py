"""Operators for training-data pipelines over documents, pages, embeddings and benchmark items.

Nothing else in the library imports this package. Functions that run in Python workers are sent by value, so executors
need only the third-party libraries, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
