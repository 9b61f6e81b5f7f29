"""Vectorised text helpers used inside Spark tasks (no Spark here).

Texts arrive as Arrow string columns; everything works on their UTF-8 bytes.
A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, as in the regular
expression ``[^\\x20\\x09-\\x0D]+``; a null text counts as empty.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
try:  # glibc alone keeps freed memory for itself
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    _TRIM = None
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: odd multipliers of the two polynomial hashes
BASES = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
_GRAM = (U64(0x100000001B3), U64(0x5851F42D4C957F2D))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: spans hashed at a time: what a worker holds for it does not grow with the block
_SPANS = 1 << 15


def release() -> None:
    """Give memory that is free back to the system: workers live on between stages beside the JVM."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls become empty texts."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off_buf, data = arr.buffers()
    offs = np.frombuffer(off_buf, np.int64 if wide else np.int32, n + 1, arr.offset * (8 if wide else 4)).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def pieces(offs: np.ndarray, max_bytes: int = 2 << 20):
    """Row ranges [a, b) of at most ``max_bytes`` of text (one row at least)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + max_bytes, "right")) - 1)
        yield a, b
        a = b


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row number of every word; words never cross rows."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    sep = _SEP[buf]
    full = offs[:-1] < offs[1:]
    before = np.empty(len(buf), bool)
    before[1:] = sep[:-1]
    before[offs[:-1][full]] = True
    after = np.empty(len(buf), bool)
    after[:-1] = sep[1:]
    after[offs[1:][full] - 1] = True
    starts = np.flatnonzero(~sep & before)
    ends = np.flatnonzero(~sep & after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A copy with A-Z lowered."""
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value (splitmix64)."""
    h = h + U64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 18)
        base = int(BASES[which])
        inverse = U64(pow(base, -1, 1 << 64))
        up, down = np.full(size, BASES[which]), np.full(size, inverse)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= 1 << 22:
            _POWERS[which] = have
    return have


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, wherever it stands; equal spans have equal hashes."""
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), _SPANS):
        first, last = starts[a : a + _SPANS], ends[a : a + _SPANS]
        low, high = int(first.min()), int(last.max())
        first, last = first - low, last - low
        up, down = _powers(which, high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((buf[low:high].astype(np.uint64) + U64(1)) * up[: high - low], out=total[1:])
        out[a : a + _SPANS] = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    return out


def gram_hash(word_hash: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (rows are not respected)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = word_hash[:n].copy()
    for j in range(1, k):
        out = out * _GRAM[which] + word_hash[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal keys in sorted arrays."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def has(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each x is in a sorted array."""
    if len(sorted_values) == 0:
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_values, x)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == x


def covered(starts: np.ndarray, width, size: int) -> np.ndarray:
    """Mask of the positions that some span [start, start + width) covers."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def join_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int) -> pa.Array:
    """One text per row: its words joined by single spaces."""
    size = ends - starts + 1
    first = np.ones(len(starts), bool)
    first[1:] = rows[1:] != rows[:-1]
    size = size - first  # the separator stands before every word but a row's first
    at = np.concatenate([[0], np.cumsum(size)])
    index = np.repeat(ends - at[1:], size) + np.arange(at[-1])
    out = buf[index] if at[-1] else np.zeros(0, np.uint8)
    out[at[:-1][~first]] = 32
    per_row = np.bincount(rows, size, n_rows).astype(np.int64) if len(rows) else np.zeros(n_rows, np.int64)
    offs = np.concatenate([[0], np.cumsum(per_row)])
    return strings(out, offs)


def strings(data: np.ndarray, offs: np.ndarray, binary: bool = False) -> pa.Array:
    """Arrow string (or binary) array from bytes and offsets."""
    kind = pa.binary() if binary else pa.string()
    return pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def ids(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def longs(column) -> np.ndarray:
    """All values of a list<bigint> column, as unsigned."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    return arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) if len(arr) else np.zeros(0, np.uint64)


def lengths(column) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.list_value_length(column).to_numpy().astype(np.int64)


def dealt(slots: np.ndarray, src: int, arrays: dict[str, np.ndarray]) -> pa.Table:
    """Rows (slot, src, one list per array): the entries grouped by their slot."""
    order = np.argsort(slots, kind="stable")
    s = slots[order]
    at = group_starts(s)
    offs = pa.array(np.concatenate([at, [len(s)]]).astype(np.int32)) if len(s) else pa.array([0], pa.int32())
    cols = {"slot": pa.array(s[at].astype(np.int32)), "src": pa.array(np.full(len(at), src, np.int32))}
    for name, values in arrays.items():
        v = values[order]
        if v.dtype == np.uint64:
            v = v.view(np.int64)
        elif v.dtype not in (np.int8, np.int32):
            v = v.astype(np.int64)
        cols[name] = pa.ListArray.from_arrays(offs, pa.array(v))
    return pa.table(cols)


def slot_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> U64(33)) % U64(n)).astype(np.int64)
