"""Training-data operators: mixing, personal data, quality, line and near duplicates,
chat rendering, language, fingerprints, decontamination, toxicity, token ids,
periodic runs and source divergence.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with their code, so these need no copy of the library.
# What is broadcast is plain data for the same reason.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
