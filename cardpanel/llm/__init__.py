"""Training-data operators on Spark (documents, pages, benchmark, labels).

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is present.  Functions that run inside tasks are
pickled by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
