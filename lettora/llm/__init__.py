"""Operators of a training-data pipeline; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Workers need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
