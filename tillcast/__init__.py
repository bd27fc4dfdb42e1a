"""Daily retail demand analytics on Spark: bronze/silver/gold tables, weather features,
forecasts, error diagnostics and recommendation texts, for any number of stores and cities."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so the executors need no
# installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
