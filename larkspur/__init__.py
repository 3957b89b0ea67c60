"""Larkspur: DataFrame operators for the data work behind language-model applications."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a job works wherever the
# driver was started from and whether or not the package is installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
