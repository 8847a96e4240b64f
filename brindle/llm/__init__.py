"""Training-data operators: scoring, cleaning, deduplication, mixing and packing of text corpora.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries.py`` holds the thin ``opN_`` queries
and their DuckDB equivalents.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Worker functions travel inside the job itself, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
