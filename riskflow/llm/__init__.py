"""Operators of a training-data pipeline over documents. Nothing else in the library imports them.

Functions that run in Python tasks are sent with their code, so executors need the
libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
