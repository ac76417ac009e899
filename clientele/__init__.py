"""Customer behaviour analysis on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from clientele.plans.analysis import Analysis, run_analysis  # noqa: E402
from clientele.sources.files import read_lines  # noqa: E402

__all__ = ["Analysis", "read_lines", "run_analysis"]
