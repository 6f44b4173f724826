"""Operators of a training-data pipeline (thirteen operators, one module each).

Nothing outside this subpackage imports it. Their registered queries and SQL are in
``queries.py``; ``corpus_pipeline.py`` at the repository top chains five of them.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
