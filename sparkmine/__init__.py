"""Spark-native data mining and modelling operators.

Every operator takes a DataFrame with an explicit id column and returns a
DataFrame; only per-column statistics and small models reach the driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions travel with the job, so executors need no installed copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
