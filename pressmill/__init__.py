"""Document ingestion and retrieval as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship this package's functions inside the tasks, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
