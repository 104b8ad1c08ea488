"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

#: Code of the operators travels with the tasks, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
