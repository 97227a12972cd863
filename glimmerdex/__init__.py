"""Hybrid keyword and vector retrieval over tables, written on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run by Python workers travel with the job, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
