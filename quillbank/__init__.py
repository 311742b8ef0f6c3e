"""Item-bank and reference-corpus analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# executors needn't have the package installed: its functions travel with the tasks that use them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
