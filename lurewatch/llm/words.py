"""Words of many texts at a time: exact codes for a chunk, hashes that are the same in all chunks."""

import numpy as np
import pyarrow as pa
import xxhash

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32   # A to Z only
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15))


def byte_set(*parts) -> np.ndarray:
    table = np.zeros(256, bool)
    for part in parts:
        table[list(part)] = True
    return table


WHITE = byte_set([0x20], range(0x09, 0x0E))


def split(texts: list, gap: np.ndarray):
    """Words of ``texts`` (bytes) in lower case: their codes, the distinct words, their texts and first bytes.

    ``gap`` tells which bytes separate words; the line feed must be one.  First bytes count in the
    texts joined by line feeds.
    """
    buffer = np.frombuffer(b"\n".join(texts), np.uint8)
    solid = ~gap[buffer]
    edge = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[buffer[solid]])])
    coded = words.dictionary_encode()
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    owner = np.searchsorted(first, starts, "right") - 1
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, owner, starts, buffer


def hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def chained(before, word):
    """Keys of word sequences from the keys of all but their last words."""
    x = before * _MIX[2] + word
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))
