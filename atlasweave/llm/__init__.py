"""Operators for preparing training text at scale.

Nothing else in the library imports this package. Functions that run inside Spark
tasks are shipped by value, so executors need this package neither installed nor on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
