"""tidyline: a Spark-native engine for curating labelled text datasets.

Every operator takes and returns DataFrames (or Columns), names its key column
explicitly and draws randomness from a seeded hash of that key, so results do
not depend on partitioning.
"""

__version__ = "0.1.0"

# Ship this package's functions to Python workers by value, so UDF kernels and
# model hooks work on executors that do not have the package installed.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
