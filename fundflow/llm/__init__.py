"""Training-data pipeline operators (language ID, sharding, dedup, extraction, ...).

Nothing else in the library imports this package.  ``registry`` holds the
queries and their SQL; the operators keep general interfaces of their own.

The functions that run inside Python tasks are pickled by value, so executors
need no copy of this package on their own disks.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
