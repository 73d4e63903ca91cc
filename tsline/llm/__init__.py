"""Operators for preparing training text at scale; nothing else in the library imports this package.

Functions that run in Python workers are pickled by value, so executors need
neither this package on their path nor a shipped archive.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
