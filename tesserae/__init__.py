"""Footprint matching, attribute inference and profiling as Spark DataFrame programs.

Python functions that run on executors are pickled by value, so a cluster needs no installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
