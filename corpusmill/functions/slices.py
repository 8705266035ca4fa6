"""Arrow batches cut to a bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

from corpusmill.functions.worker import give_back

SLICE_BYTES = 1 << 21  # of a batch that a task works on at a time


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in their order, a few at a time.

    A batch of long texts may hold a whole partition, and what a task makes of it is often
    several times as large. A single longer row is a slice of its own. At the end, free
    memory goes back to the system.
    """
    for batch in batches:
        yield from _halved(batch)
    give_back()


def _halved(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if batch.num_rows < 2 or batch.nbytes <= SLICE_BYTES:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _halved(batch.slice(0, half))
    yield from _halved(batch.slice(half))
