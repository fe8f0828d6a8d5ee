"""eventide: keyed event analytics on Spark DataFrames, SQL and Structured Streaming."""

import sys as _sys

__version__ = "0.1.0"

# Python workers on a cluster do not have this package installed: ship the
# functions used inside pandas UDFs by value instead of by module reference.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on the workers' path
    pass
