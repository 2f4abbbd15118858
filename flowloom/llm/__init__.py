"""Operations of a training-data pipeline: tokenising, formatting, cleaning, matching, packing and sharding texts."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors with their code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
