"""Operators for preparing training text at scale; nothing else in the library imports them.

Functions that run in tasks are sent by value, so executors need the third-party libraries
but no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
