"""terrasift: Spark analytics for natural-disaster tables and images.

Every public operator takes and returns a ``DataFrame``; the work stays in
Spark jobs (scans, partial aggregates, shuffles, MLlib fits, Arrow batches).
"""

import sys

from pyspark import cloudpickle

from terrasift.registry import DatasetSpec, dataset, register
from terrasift.session import build_session, scratch_path

# Functions that run in Python workers travel with the task, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DatasetSpec", "build_session", "dataset", "register", "scratch_path"]
