"""Operators for training-data corpora: tokens, quality, personal data, main text, neighbours, packing, languages, copies, licences, secrets.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# workers receive the helpers by value, so they need no install of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
