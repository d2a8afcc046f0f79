"""Operators for building training corpora, each in its own module.

Nothing outside this package imports it. Functions that run inside Spark tasks are
pickled by value, so executors need only the third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
