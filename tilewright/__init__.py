"""Scene catalogs on Spark: derive, build, maintain, check and search them."""

import sys

from pyspark import cloudpickle

# UDF code travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
