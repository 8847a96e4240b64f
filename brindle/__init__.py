"""A Spark engine for turning loosely structured documents and tables into measured records."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Worker functions travel inside the job itself, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
