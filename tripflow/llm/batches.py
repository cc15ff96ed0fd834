"""Arrow batches of texts in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``most`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def large_text(column: pa.Array) -> pa.Array:
    """Texts with 64-bit offsets, null as empty.

    The copy starts at offset 0: ``ascii_lower`` of Arrow 23 gives wrong texts
    for arrays whose first offset is not.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    return texts.take(pa.array(np.arange(len(texts))))
