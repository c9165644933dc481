"""Conversation-feedback analytics and corpus preparation as Spark jobs."""

import sys

from pyspark import cloudpickle

# What tasks run travels with them; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
