"""Wearable-sensor stream analytics as Spark DataFrame and Structured Streaming operators."""

import sys

from pyspark import cloudpickle

# functions sent to executors carry their code along, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
