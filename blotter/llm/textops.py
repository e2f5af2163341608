"""Helpers shared by the operators: Arrow strings as byte arrays, vectorised word and window hashes.

Hashes are polynomials modulo 2**64 over a random byte table, computed from prefix sums, so a whole Arrow batch is
hashed with a few numpy passes. All tables come from a fixed seed: every worker, task and retry sees the same values.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

#: The white space of all word definitions here: blank and 0x09 to 0x0D.
WHITE = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 1 << 20
#: Text that is shingled at a time; about 40 bytes are held for each of its bytes.
SHINGLE_BYTES = 1 << 17


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker (functions are unpickled anew for every task)."""
    name = "_text_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].data = {}
    return sys.modules[name].data


def enter(owner: str) -> None:
    """To be called by a task first: what other operators' tasks left in this worker's cache is dropped, so a worker holds one operator's tables."""
    cache = worker_cache()
    if cache.get("owner") != owner:
        cache.clear()
        cache["owner"] = owner
        pa.default_memory_pool().release_unused()


class Memo:
    """A bounded memory of two generations of at most ``size`` entries: when the newer is full it becomes the older, and what is used again moves back."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


def byte_view(arr) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and its len + 1 offsets; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    _, offs, body = arr.buffers()
    off = np.frombuffer(offs, kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES, most: int = 8192):
    """Ranges (i, j) of at most ``most`` documents of at most ``limit`` bytes together; a longer document comes alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n, i + most)
        yield i, j
        i = j


def hash_tables(seed: int, fold: bool = False) -> tuple[np.ndarray, int]:
    """A random 64-bit value per byte and an odd base; ``fold`` gives A-Z the values of a-z."""
    rng = np.random.default_rng(seed)
    table = rng.integers(1, 2**64, 256, dtype=np.uint64)
    base = int(rng.integers(1, 2**62)) * 4 + 3
    if fold:
        table[65:91] = table[97:123]
    return table, base


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    got = cache.get(("powers", base))
    if got is None or len(got[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        inverse = pow(base, -1, 2**64)

        def run(b: int) -> np.ndarray:
            a = np.full(size, b, np.uint64)
            a[0] = 1
            return np.multiply.accumulate(a)

        got = run(base), run(inverse)
        if size <= 4 * BLOCK_BYTES:
            cache["powers", base] = got
    return got


def prefix_hash(data: np.ndarray, seed: int, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(H, inverse powers): the hash of data[a:b] is (H[b] - H[a]) * inverse[a]."""
    table, base = hash_tables(seed, fold)
    power, inverse = _powers(base, len(data) + 1)
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[: len(data)], out=h[1:])
    return h, inverse


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64), so that every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the index of its first word (plus the total)."""
    white = np.zeros(256, bool)
    white[np.frombuffer(WHITE, np.uint8)] = True
    inside = ~white[data]
    first = np.zeros(len(data) + 1, bool)  # document starts
    first[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, off)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, seed: int, fold: bool = False) -> np.ndarray:
    h, inverse = prefix_hash(data, seed, fold)
    return mix64((h[e] - h[s]) * inverse[s])


def window_sums(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each window of n consecutive word hashes (an array of len(h) - n + 1, at least 0)."""
    k = np.random.default_rng(seed).integers(1, 2**64, n, dtype=np.uint64) | np.uint64(1)
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out += h[i : i + m] * k[i]
    return mix64(out)


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int, seed: int = 11, fold: bool = True):
    """For each document the sorted distinct hashes of its n-word shingles (uint64).

    A document with 1 to n - 1 words has its whole sequence as the only shingle, one without words has none.
    """
    for i, j in blocks(off, SHINGLE_BYTES):
        d, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        s, e, w = word_bounds(d, o)
        h = word_hashes(d, s, e, seed, fold)
        full = window_sums(h, n, seed + n)
        for k in range(j - i):
            a, b = int(w[k]), int(w[k + 1])
            if b - a >= n:
                yield np.unique(full[a : b - n + 1])
            elif b > a:
                yield window_sums(h[a:b], b - a, seed + n)
            else:
                yield full[:0]
