"""Arrow batches of a partition that is sorted by its first column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of column 0, which come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            piece = batch.slice(a, b - a)
            if held and held[-1].column(0)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)
