"""Operators for preparing training text at scale.

One module per operator; ``queries`` registers the thin benchmark queries.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value, so that executors need not
# have it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
