"""Veilframe: document-privacy analytics as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Python functions that reach executors travel with their code, so that a worker does not
# need this package on its own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
