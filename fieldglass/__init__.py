"""Fieldglass: tournament-style analytics as declarative Spark plans."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions are sent to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
