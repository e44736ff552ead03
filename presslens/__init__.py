"""Entity resolution and coverage statistics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Helpers used inside Arrow batches travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
