"""Word hashes of whole texts, a batch of rows at a time.

A word is a maximal run of bytes other than `[\\x20\\x09-\\x0D]`. Words are hashed as
polynomials over the text's UTF-8 bytes, read off one running sum, so that no Python
object is made per word. Texts are walked in slices that end between words; a slice
grows only for a single word longer than it.
"""

import ctypes

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
PIECE_BYTES = 2 << 20
GROUP_SEED = 20240607

# Memory of large arrays goes back to the system when they are freed, so that a worker that
# is kept for later tasks holds little: fixed thresholds for glibc, and Arrow on top of it.
try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    _libc.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
    pa.set_memory_pool(pa.system_memory_pool())
except OSError:  # another C library
    pass

_U = np.uint64
_rng = np.random.default_rng(GROUP_SEED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = _U(0x9E3779B97F4A7C13)  # 3 modulo 4, see `_powers`
_INVERSE = _U(pow(0x9E3779B97F4A7C13, -1, 2**64))
_STEP = _U(0xD1342543DE82EF95)
_cache = {}


def _powers(n):
    """Powers of the base and of its inverse, kept between slices."""
    if len(_cache.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _cache[name] = np.cumprod(table)
    return _cache["up"], _cache["down"]


def mix(x):
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def buffers(column):
    """UTF-8 bytes and row offsets of an Arrow string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch, column="text", limit=PIECE_BYTES):
    """Cut a record batch into runs of rows holding about `limit` bytes of text each."""
    sizes = np.diff(buffers(batch.column(column))[1])
    group = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(sizes)], strict=True):
        if hi > lo:
            yield batch.slice(int(lo), int(hi - lo))


def _slices(data, space):
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + SLICE_BYTES)
        while hi < n and not space[hi]:
            after = np.flatnonzero(space[hi : hi + 4096])
            hi = hi + int(after[0]) if len(after) else min(n, hi + 4096)
        yield lo, hi
        lo = hi


def scan(data, offsets, lower=False, breaks=None):
    """Hash, row, first and last byte (exclusive) of every word, in text order.

    `breaks` marks the bytes that separate words; by default the six blanks."""
    table = _LOWER if lower else _BYTE
    space = _SPACE[data] if breaks is None else breaks
    # a row's end also ends a word: rows are told apart by an edge flag
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    hashes, first, last = [], [], []
    for lo, hi in _slices(data, space):
        up, down = _powers(hi - lo + 1)
        solid = ~space[lo:hi]
        before = np.r_[True, ~solid[:-1]] | edge[lo:hi]
        after = np.r_[~solid[1:], True] | edge[lo + 1 : hi + 1]
        starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[data[lo:hi]] * up[: hi - lo], out=run[1:])
        hashes.append(mix((run[ends] - run[starts]) * down[starts]))
        first.append(starts + lo)
        last.append(ends + lo)
    none = np.zeros(0, np.int64)
    first, last = np.concatenate([none, *first]), np.concatenate([none, *last])
    rows = np.searchsorted(offsets, first, side="right") - 1
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), rows, first, last


def segment_hashes(data, starts):
    """Hash of every segment of `data`; segments begin at `starts` and tile the bytes."""
    ends = np.r_[starts[1:], len(data)]
    out, lo = np.zeros(len(starts), np.uint64), 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SLICE_BYTES, side="right")))
        begin, stop = starts[lo], ends[hi - 1]
        up, down = _powers(int(stop - begin) + 1)
        run = np.zeros(stop - begin + 1, np.uint64)
        np.cumsum(_BYTE[data[begin:stop]] * up[: stop - begin], out=run[1:])
        a, b = starts[lo:hi] - begin, ends[lo:hi] - begin
        out[lo:hi] = mix((run[b] - run[a]) * down[a])
        lo = hi
    return out


def grams(hashes, rows, k):
    """Hash of every run of `k` words of one row, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts, size = {1: hashes}, 1
    while size * 2 <= k:
        one = parts[size]
        parts[size * 2] = mix(one[:-size] * _STEP + one[size:] + _U(size))
        size *= 2
    out, done = None, 0
    for size in sorted(parts, reverse=True):
        if done + size <= k:
            part = parts[size][done : done + n]
            out = part if out is None else mix(out * _STEP + part + _U(size))
            done += size
    at = np.flatnonzero(rows[:n] == rows[k - 1 : k - 1 + n])
    return out[at], at


def bounds(rows, n):
    """First index of each of `n` rows in the sorted array `rows`, and the end."""
    return np.searchsorted(rows, np.arange(n + 1))
