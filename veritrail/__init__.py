"""veritrail: a Spark-native engine for analysing rollouts with verifiable rewards."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need not have the package installed: functions are sent to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
