"""Spark-native operators for the working life of a tabular data set."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its few Python functions
# travel with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
