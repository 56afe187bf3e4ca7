"""Group-outcome analysis as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

from outcome_lens.contract import CENSUS, AnalysisError, Field, Outcome, SourceContract

# functions that run in Python workers travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CENSUS", "AnalysisError", "Field", "Outcome", "SourceContract"]
