"""Operators for building training corpora.

Each operator is one module with a general interface; ``queries`` binds them to the test
tables. Functions of this package that run inside tasks are shipped with the job, so the
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
