"""Sums of fixed-size vectors over all tasks.

Each task sends its partial vector in slices; slices are added in two rounds of groups, so that no task meets more
than a share of them, and only the final vector (its size is a parameter, not the data's) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

PART = "slice int, lane int, data binary"
WIDTH = 8192
LANES = 256


def parts(vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows a task sends for its partial vector of 64-bit floats."""
    lane = TaskContext.get().partitionId() % LANES
    vector = np.ascontiguousarray(vector, np.float64)
    cuts = [vector[i : i + WIDTH].tobytes() for i in range(0, len(vector), WIDTH)]
    n = len(cuts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int32()), pa.array([lane] * n, pa.int32()), pa.array(cuts, pa.binary())],
        ["slice", "lane", "data"],
    )


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(d, np.float64) for d in frame["data"])
    return pd.DataFrame({"slice": frame["slice"][:1], "lane": frame["lane"][:1], "data": [total.tobytes()]})


def total(sent: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' vectors; zeros when there were no tasks."""
    found = np.zeros(size)
    summed = sent.groupBy("slice", "lane").applyInPandas(_add, PART).groupBy("slice").applyInPandas(_add, PART)
    for row in summed.select("slice", "data").collect():
        part = np.frombuffer(row["data"], np.float64)
        found[row["slice"] * WIDTH : row["slice"] * WIDTH + len(part)] = part
    return found
