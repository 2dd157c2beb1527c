"""Batch analytics over semi-structured job postings, on Spark DataFrames.

``sources``    raw dumps, keyword seeds, published tables
``functions``  Column -> Column text and number rules, also as SQL functions
``operators``  DataFrame -> DataFrame steps: land, stage, unify, tag, model, check, report
``plans``      the daily run: land each source, build and check the models
``streaming``  the same landing step driven by newly arriving files
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the plan, so the
# package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
