"""Move tables from one schema version to the next with Spark, and prove the result."""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
