"""brindle: a PySpark-native engine for curating package metadata and documents."""

import sys

from pyspark import cloudpickle

#: Functions of the package travel to the workers by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
