"""Data work on text, documents and tables with language models in the loop, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the job: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
