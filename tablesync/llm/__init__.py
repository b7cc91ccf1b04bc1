"""Operators for preparing training data.

Nothing else in the library imports this package. Its task-side functions are
shipped to the workers by value, so workers need not have it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
