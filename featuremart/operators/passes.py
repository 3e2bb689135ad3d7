"""Sums of arrays over all rows, worked out batch by batch in the tasks and added in two levels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tasks whose sums are added before they reach the driver.
SLOTS = 32


def vectors(column: pa.Array) -> np.ndarray:
    """Rows of a list column of doubles of one length."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def few_tasks(rows: DataFrame) -> bool:
    """Whether ``rows``, a stored table, is read by so few tasks that the driver may add their sums."""
    return rows.rdd.getNumPartitions() <= SLOTS


def summed(rows: DataFrame, partial: Callable[[pa.RecordBatch], dict[int, np.ndarray]], few: bool = False) -> dict[int, np.ndarray]:
    """Sum by key of the arrays that ``partial`` gives for every Arrow batch of ``rows``, which are read once.

    A task keeps one array a key; unless there are ``few`` tasks, they are added in SLOTS
    groups first, so that what reaches the driver doesn't grow with the data.
    """
    schema = pa.schema([("slot", pa.int32()), ("key", pa.int64()), ("values", pa.list_(pa.float64()))])

    def table(slot: int, sums: dict[int, np.ndarray]) -> dict:
        return {"slot": pa.array([slot] * len(sums), pa.int32()), "key": pa.array(list(sums), pa.int64()),
                "values": pa.array([v.ravel() for v in sums.values()], pa.list_(pa.float64()))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, value in partial(batch).items():
                sums[key] = sums[key] + value if key in sums else value
        if sums:
            yield pa.RecordBatch.from_pydict(table(TaskContext.get().partitionId() % SLOTS, sums), schema)

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(v.values) for v in group.column("values")], axis=0)
        return pa.table(table(group.column("slot")[0].as_py(), {group.column("key")[0].as_py(): total}), schema=schema)

    ddl = "slot int, key long, values array<double>"
    out: dict[int, np.ndarray] = {}
    sums = rows.mapInArrow(run, ddl)
    if not few:
        sums = sums.groupBy("slot", "key").applyInArrow(lambda g: add(g), ddl)
    for row in sums.toArrow().to_pylist():
        value = np.array(row["values"])
        out[row["key"]] = out[row["key"]] + value if row["key"] in out else value
    return out
