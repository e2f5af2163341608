"""The part-of-day label as a vectorised pandas UDF (the user-defined-function API).

The native ``daypart`` expression is the fast path; this UDF exists for the
reference's UDF usage. It is serialised by value (bins captured as default
arguments), so executors need no copy of this package to run it.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from blotter.functions.timeparts import DAYPART_BINS, DAYPART_OTHER


def daypart_labels(s, bins=DAYPART_BINS, other=DAYPART_OTHER):
    t = pd.to_numeric(s, errors="coerce")
    out = pd.Series(other, index=s.index, dtype="object")
    for label, ranges in reversed(bins):
        hit = pd.Series(False, index=s.index)
        for lo, hi in ranges:
            hit |= (t >= lo) & (t <= hi)
        out[hit.fillna(False)] = label
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])

daypart_udf = F.pandas_udf(daypart_labels, StringType())
