"""Résumé and document analytics expressed as Spark jobs.

Layers: ``sources`` (landing files, tables, staging), ``functions`` (column
expressions), ``operators`` (DataFrame to DataFrame), ``streaming`` (ingest and
live shortlist) and ``plans`` (the whole lake, the reader tools, and the
queries the driver checks).
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run in tasks travel with the task, so workers
# need no copy of it on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
