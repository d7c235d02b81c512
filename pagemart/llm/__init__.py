"""Training-data operators: extraction, deduplication, quality, tokens, mixing and vector search.

Nothing else in the package imports this folder; ``queries`` holds the registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
