"""riskframe: rare-event risk scoring as Spark jobs (DataFrame, SQL, Spark ML, Arrow-batched pandas).

Python workers import this package to run the pandas functions (local training, scoring).  In local
mode they inherit the driver's environment, so the package root is exported on ``PYTHONPATH`` here;
on a cluster ship the package with ``--py-files`` (or ``SparkContext.addPyFile``).
"""

import os as _os

_root = _os.path.dirname(_os.path.dirname(_os.path.abspath(__file__)))
_paths = [p for p in _os.environ.get("PYTHONPATH", "").split(_os.pathsep) if p]
if _root not in _paths:
    _os.environ["PYTHONPATH"] = _os.pathsep.join([_root, *_paths])
