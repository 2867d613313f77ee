"""Operators of a training-data pipeline over large text, page, conversation
and vector tables. Self-contained: nothing else in the library imports it."""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors by value, so that the
# package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
