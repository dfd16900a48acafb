"""Operators for preparing language-model training data.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds its
queries when it is there. Each operator has a general function of its own and a thin
``opN_*`` query in :mod:`sousflow.llm.queries`.
"""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
