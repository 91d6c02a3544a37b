"""What a function makes of the rows of each group, in one Arrow stream a task.

``applyInArrow`` and ``applyInPandas`` open vectors anew for each group, and the pool that an executor takes them from does not
give them back: its memory outside the heap grows with the number of groups.  Here rows are exchanged and sorted by
their keys, and ``mapInArrow`` brings them in batches, of which a task holds one, and the group that is not yet whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The groups of rows that come sorted by ``keys``, whatever batches they are cut into; no key is null."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for key in keys:
            column = batch.column(key)
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            new[0] |= bool(held) and held[-1].column(key)[-1] != column[0]
        bounds = np.unique([0, *np.flatnonzero(new), batch.num_rows]).tolist()
        for start, end in zip(bounds, bounds[1:], strict=False):
            if new[start] and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def by_group(rows: DataFrame, keys: Sequence[str], function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` of all rows of each group of ``keys``, none of which is null; a group must fit into one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, keys):
            yield from function(group).to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
