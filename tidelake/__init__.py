"""tidelake: a Spark-native toolkit for a content-addressed lake of sports snapshots.

Every public operator takes and returns DataFrames; nothing is collected, and
Catalyst plans the whole job.  See README.md for the map of the package.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
