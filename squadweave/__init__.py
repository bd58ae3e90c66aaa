"""Roster records to entity graph, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that it need
# be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
