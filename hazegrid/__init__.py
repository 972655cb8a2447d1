"""Sensor-network analytics as DataFrame -> DataFrame operators on Apache Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: workers need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
