"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage run inside Python tasks; they travel with the task, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
