"""causeway: effect measurement on Spark tables and panels."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
