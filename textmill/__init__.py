"""Text tables in, model-ready rows out, as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Ship the package's small task-side helpers with the tasks, so executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
