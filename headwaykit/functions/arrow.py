"""Running sorted-stream state machines over partitions: rows arrive in order, memory stays bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_stream(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    machine: Callable[[], Machine],
    fields: list[tuple[str, pa.DataType]],
) -> DataFrame:
    """Feeds each group's rows in order to a machine; groups are never held in memory.

    keys partition and come first in the sort, order follows. machine() makes the state of a
    partition; `fields` are its output columns.
    """
    sorted_rows = rows.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, open_key = machine(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            key_columns = [columns[k].to_pylist() for k in keys]
            cuts = np.zeros(batch.num_rows, dtype=bool)
            for values in key_columns:
                array = np.array(values, dtype=object)
                cuts[1:] |= array[1:] != array[:-1]
            starts = [0, *np.flatnonzero(cuts).tolist(), batch.num_rows]
            state.load(columns)
            for i, j in zip(starts, starts[1:]):
                key = tuple(values[i] for values in key_columns)
                if key != open_key:
                    if open_key is not None:
                        state.finish()
                    state.start(key)
                    open_key = key
                state.feed(i, j)
            if state.size() >= 20_000:
                yield state.take()
        if open_key is not None:
            state.finish()
        if state.size():
            yield state.take()

    return sorted_rows.mapInArrow(run, ddl(fields))


class Machine:
    """Base of the machines: collects output rows and hands them over as record batches."""

    fields: list[tuple[str, pa.DataType]] = []

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.key: tuple = ()

    def load(self, columns: dict[str, pa.Array]) -> None:
        raise NotImplementedError

    def start(self, key: tuple) -> None:
        self.key = key

    def feed(self, i: int, j: int) -> None:
        raise NotImplementedError

    def finish(self) -> None:
        raise NotImplementedError

    def size(self) -> int:
        return len(self.rows)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(column, type=kind) for column, (_, kind) in zip(columns, self.fields)],
            names=[name for name, _ in self.fields],
        )


def ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    """The fields of a machine as a Spark schema string."""
    kinds = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean"}
    return ", ".join(f"`{name}` {kinds[kind]}" for name, kind in fields)
