"""Operators for large corpora of training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors need no copy of the package: functions of this subpackage travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
