"""Operators for training-data corpora: one module per operator, queries in ``queries``.

The functions run inside Python workers travel with the plan, so executors
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
