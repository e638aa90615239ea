"""Street-centerline and address-range processing as Spark jobs.

Operators take and return DataFrames.  Nothing here starts a session; pass in
the one the cluster gives you, or use ``centerline.session.local_session``.
"""

from pyspark.cloudpickle import register_pickle_by_value as _by_value

import sys as _sys

# Functions that run in Python workers travel with the job, so that executors
# need no copy of this package on their path.
_by_value(_sys.modules[__name__])

__version__ = "0.1.0"
