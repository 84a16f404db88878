"""Sums of outer products, added up in blocks inside the tasks."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gram(df: DataFrame, cells: list[Column]) -> np.ndarray:
    """The sum of v v' over all rows of a table that is not empty, v the vector of the given cells.

    One pass without a shuffle of rows: each task adds up one matrix of the cells' size, and the matrices are merged in a
    tree. Only the result, whose size is that of the cells, reaches the driver.
    """
    vectors = df.select(array_to_vector(F.array(*cells)).alias("v"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), 0, len(cells)).computeGramianMatrix().toArray()
