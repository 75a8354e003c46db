"""Operators for training-data pipelines.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only where it can be imported. Every operator is general: column names
are parameters, extra columns never matter (each operator first projects what
it needs), and it returns DataFrames whose work is partitioned by Spark.
"""

import sys

from pyspark import cloudpickle

# Tasks receive these functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
