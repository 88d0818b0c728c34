"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# What runs in tasks is sent with them, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
