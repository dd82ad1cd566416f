"""Bloom filters of strings, built and asked in tasks."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value

# Bits of a filter for each string, and how many of them a string sets: about one in a
# million other strings passes.
BITS = 32
PROBES = 12
LEAST_BITS = 1024
_CHUNK = 50_000

# Functions that run in tasks travel with the job, so executors need no copy of the library.
register_pickle_by_value(sys.modules[__name__])


def _places(strings: Sequence[str], size: int) -> Iterator[np.ndarray]:
    """The bits of each string, chunk by chunk: steps of one half of a digest from the other."""
    for i in range(0, len(strings), _CHUNK):
        digests = b"".join(hashlib.blake2b(s.encode(), digest_size=16).digest() for s in strings[i : i + _CHUNK])
        halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
        k = np.arange(PROBES, dtype=np.uint64)
        # The cubic term keeps strings apart whose steps agree in a small filter.
        steps = (halves[:, 1:] | np.uint64(1)) * k + (k**3 - k) // np.uint64(6)
        yield ((halves[:, :1] + steps) % np.uint64(size)).astype(np.int64)


def bloom_filter(strings: Sequence[str]) -> bytes:
    """Filter of the strings; its size follows their number."""
    bits = np.zeros(max(LEAST_BITS, (len(strings) * BITS + 7) // 8 * 8), bool)
    for places in _places(strings, len(bits)):
        bits[places] = True
    return np.packbits(bits).tobytes()


def any_passes(strings: Sequence[str], bits: bytes) -> bool:
    """Whether the filter lets one of the strings pass: always if it was made of it, else rarely."""
    table = np.frombuffer(bits, np.uint8)
    for places in _places(strings, 8 * len(bits)):
        if ((table[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=1).any():
            return True
    return False
