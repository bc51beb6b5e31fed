"""Operators for preparing language-model training data.

Python functions of this package are sent to the executors by value, so a cluster needs
no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
