"""tidemark: a PySpark-native engine for event-driven operations data."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
