"""Matrices summed over tasks: a task yields its sum row by row, rows are added in tasks again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from paxflow.llm.memory import frees_memory

LINE_DDL = "at int, line array<double>"


def matrix_lines(matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    lines = pa.array(matrix.tolist(), pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(range(len(matrix)), pa.int32()), lines], ["at", "line"])


def summed_matrix(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of the tasks' matrices (LINE_DDL); the driver gets the result only."""

    @frees_memory
    def join(part: pa.Table) -> pa.Table:
        lines = pc.list_flatten(part.column("line")).to_numpy().reshape(-1, width)
        lines = lines[np.lexsort(lines.T[::-1])]  # an order that does not depend on arrival
        at = part.column("at")[0].as_py()
        return pa.table({"at": pa.array([at], pa.int32()), "line": pa.array([lines.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    lines = parts.groupBy("at").applyInArrow(join, LINE_DDL).collect()
    return np.array([r["line"] for r in sorted(lines, key=lambda r: r["at"])])
