"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import streamweir
from pyspark import cloudpickle

# executors need not have the package installed: its functions travel with the tasks
cloudpickle.register_pickle_by_value(streamweir)
