"""Training-data operators: tables of texts, pages and conversations in, DataFrames out.

Nothing else in the library imports this package. Python workers import it by name
where they can find it (an installed package, ``PYTHONPATH``, the working folder);
where they cannot, its functions travel with the job.
"""

import os
import sys

from pyspark import cloudpickle

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SEEN = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
if _ROOT not in map(os.path.abspath, _SEEN) and "site-packages" not in _ROOT:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
