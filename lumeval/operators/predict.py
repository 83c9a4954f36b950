"""User predictors and scorers that need Python (L4).

``predict_with`` wraps a vectorised user function ``pd.Series -> pd.Series``
in an Arrow-batched pandas UDF: rows move in column batches, never one by
one.  Calls to remote model services are the caller's business; the engine
only batches rows to the function and keeps its output as a column.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predict_with(df: DataFrame, fn: Callable[[pd.Series], pd.Series], input_col: str,
                 output_col: str = "output", return_type: str = "string") -> DataFrame:
    udf = F.pandas_udf(fn, return_type)
    return df.withColumn(output_col, udf(F.col(input_col)))
