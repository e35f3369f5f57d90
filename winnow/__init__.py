"""Table operators that turn harvested web data into a labelled text corpus, on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the plan, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
