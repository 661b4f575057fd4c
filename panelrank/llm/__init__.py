"""Operators for training-data pipelines. Nothing else in the package imports this subpackage.

Functions that run in tasks are shipped by value, so executors need numpy and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
