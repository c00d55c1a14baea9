"""Change-event processing on Spark: captured PostgreSQL and MySQL log
messages in, one insert / update / delete row-event schema out."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python workers get the row codec with the task, so a cluster needs no copy
# of this package on its executors.
register_pickle_by_value(sys.modules[__name__])
