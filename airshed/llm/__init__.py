"""Operators for preparing training data. Nothing outside imports this subpackage.

Functions that run inside tasks are shipped by value: executors need the
libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
