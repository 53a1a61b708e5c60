"""Taxonomy retrieval and classification as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Task-side functions travel by value, so executors need numpy and pyarrow but
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
