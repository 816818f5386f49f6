"""Training-data operators. Task code travels with the job, so executors need no copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
