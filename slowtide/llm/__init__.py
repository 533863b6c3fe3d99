"""Training-data operators; nothing outside this folder and corpus_pipeline.py uses them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
