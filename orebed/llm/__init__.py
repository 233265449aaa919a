"""Operators for preparing training text, and the queries and pipeline built on them.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so that the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
