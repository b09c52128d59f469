"""Operators for preparing training text at scale.

Worker functions are pickled by value, so executors need the libraries they
use (numpy, xxhash, pyahocorasick) but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
