"""Operators for preparing training text at scale.

One module per operator. ``queries.py`` holds the thin registered queries; the
rest of the library imports nothing from here.

Functions that run in Python workers travel by value, so executors need not
have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
