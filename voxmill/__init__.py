"""Customer-feedback analytics expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Worker functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
