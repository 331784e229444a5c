"""tidemark: smoothing-filter analytics for ordered series on Spark DataFrames.

Everything is a ``DataFrame -> DataFrame`` function that can be chained with
``df.transform``. Series are identified by a :class:`SeriesSpec` (key columns and
an order column); filters, features, metrics and the experiment driver all run as
Spark plans.
"""

import sys as _sys

try:  # ship our helpers inside pickled UDF closures: workers need not import the package
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - fall back to session.ship_package
    pass

from tidemark.operators.index import SeriesSpec  # noqa: E402

__all__ = ["SeriesSpec"]
__version__ = "0.1.0"
