"""Slices of Arrow batches that are worked on at a time, and numbers packed into bytes."""

import numpy as np
import pyarrow.compute as pc
import zstandard


def numbered(items):
    """Items with chunk numbers of their own.  A number holds once the rows made from it are written."""
    from pyspark import TaskContext
    base = TaskContext.get().partitionId() << 32
    for n, item in enumerate(items):
        yield base + n, item


def sliced(batches, text: int, limit: int):
    """Slices with about ``limit`` bytes in the column at ``text``; a longer text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False) + 1)
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def pack(array) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 1)


def unpack(data, kind):
    return np.frombuffer(zstandard.decompress(data), kind)


def pack_planes(numbers) -> bytes:
    """Whole numbers byte by byte, the low bytes of all first: small ones take little room."""
    wide = np.ascontiguousarray(numbers).astype("<i8")
    return pack(wide.view(np.uint8).reshape(-1, 8).T)


def unpack_planes(data):
    return np.ascontiguousarray(unpack(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def pack_sorted(keys) -> bytes:
    """Sorted unsigned 64-bit numbers as differences."""
    return pack_planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data):
    return np.cumsum(unpack_planes(data).view(np.uint64), dtype=np.uint64)
