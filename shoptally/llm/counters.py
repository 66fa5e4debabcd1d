"""How often hashes occur in all rows, in a table of fixed size.

Each hash counts in one of ``SLOTS`` slots, so a count is never too low and, with slots shared, may be
too high.  Tasks count their rows, the tables are summed in ``PARTS`` parts by as many tasks, and the sum is what
the driver gets: SLOTS numbers, whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLOTS = 1 << 19
#: So many that a batch of Arrow, of 10,000 rows, is small: a part comes from every task.
PARTS = 512
SCHEMA = "part int, counts binary"


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) % np.uint64(SLOTS)).astype(np.int64)


class Counter:
    """Counts of one task."""

    def __init__(self) -> None:
        self.total = np.zeros(SLOTS, np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        self.total += np.bincount(slot(hashes), minlength=SLOTS).astype(np.uint32)

    def parts(self) -> Iterator[pa.RecordBatch]:
        if self.total.any():
            blobs = pa.array([p.tobytes() for p in np.split(self.total, PARTS)])
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), blobs], names=["part", "counts"])


def summed(counted: DataFrame) -> np.ndarray:
    """The sum of all tasks' counts, from their parts (part, counts)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        if sums:
            blobs = pa.array([v.tobytes() for v in sums.values()])
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), blobs], names=["part", "counts"])

    total = np.zeros((PARTS, SLOTS // PARTS), np.int64)
    for row in counted.repartition("part").mapInArrow(add, SCHEMA).collect():
        total[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return total.ravel()
