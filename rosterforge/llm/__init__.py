"""Operators for training-data pipelines. Nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# the functions of these modules travel with the query, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
