"""plumbline: profiling, cleaning, feature building and regression on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from plumbline.session import get_spark

__all__ = ["get_spark"]

#: Functions that run in Python workers travel by value: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
