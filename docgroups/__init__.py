"""Group documents and vectors without labels, then score the groups, on Spark."""

import sys

from pyspark import cloudpickle

# Ship the package's own functions with each task, so workers need only numpy and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
