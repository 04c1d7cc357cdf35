"""quern: corpus preparation, quality, page and evaluation operators on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Ship the few Python helpers inside the serialized functions, so executors do
# not need this package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
