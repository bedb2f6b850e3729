"""minekit: data-mining operators expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Task code that lives in this package travels with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
