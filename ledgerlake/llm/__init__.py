"""Operators for preparing language-model training data. Nothing else in the library imports this subpackage.

Functions of this subpackage travel to the executors with the jobs that use them, so nothing has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
