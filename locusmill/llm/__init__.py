"""Operators for preparing training data: one module per operator, registered in ``registry``.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
