"""Arrow batches in slices, for functions that turn values into Python objects."""

from collections.abc import Iterator

#: Bytes and rows of a slice at most (one row at least): what a worker holds as Python objects doesn't grow with the batches that Spark sends.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512


def sliced(batches: Iterator, size: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator:
    """The arrays (tuples of arrays, record batches) of an Arrow function in slices, in order."""
    for batch in batches:
        columns = batch if isinstance(batch, tuple) else (batch,)
        n, held = len(columns[0]), sum(c.nbytes for c in columns)
        step = max(1, min(rows, n * size // max(held, 1)))
        for at in range(0, n, step) or (0,):
            part = tuple(c.slice(at, step) for c in columns)
            yield part if isinstance(batch, tuple) else part[0]
