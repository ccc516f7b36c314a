"""Training-data operators: one module per operator, ``queries`` registers them.

Functions of this subpackage travel to the executors by value, so the package
itself need not be installed there."""

import sys

from pyspark.cloudpickle import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
