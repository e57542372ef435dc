"""Market-risk analytics over daily price bars, written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from marketlens.params import RiskParams

# Functions that run inside tasks travel with the job: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["RiskParams"]
