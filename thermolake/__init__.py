"""Spark-native sensor lakehouse, quality gate and hybrid text retrieval."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need numpy, pandas and
# pyarrow, but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
