"""Vectorised 64-bit hashes of words inside Arrow string columns.

A word's hash is a polynomial over random byte values, taken from prefix sums of
the batch's bytes and finished by a bijective mix, so it depends on the bytes
alone: equal words hash alike in every task and run. Two given words collide
with probability of about 2**-60."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
CHUNK = 1 << 21


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix64((b + np.uint64(1)) * np.uint64(_P)) | np.uint64(1)


_VALUES = {k: _byte_values(k) for k in (False, True)}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = np.full(max(n, CHUNK + 1), _P if kind == "up" else _P_INV, np.uint64)
        base[0] = 1
        have = np.cumprod(base)
        if len(have) <= 4 * CHUNK:
            _powers[kind] = have
    return have


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        # a run of spans within CHUNK bytes (at least one)
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        s = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_VALUES[lower][data[lo:hi]] * _power("up", hi - lo + 1)[:hi - lo], out=s[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (s[b] - s[a]) * _power("down", hi - lo + 1)[a]
        i = j
    return mix64(out + (ends - starts).astype(np.uint64) * np.uint64(_P))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[off[0]:off[-1]] if body is not None else np.empty(0, np.uint8)
    return data, off - off[0]


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all white-space separated words of all texts (null: none), and
    the position of each text's first word (one more entry than texts)."""
    if not len(texts):
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    data, off = _bytes_of(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(off), np.int64)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = np.flatnonzero(off[1:] > off[:-1])
    at, to = off[:-1][full], off[1:][full] - 1
    first[at], last[to] = word[at], word[to]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return _spans(data, starts, ends, lower), np.searchsorted(starts, off)


def string_hashes(strings: pa.Array) -> np.ndarray:
    """One hash for each whole string."""
    if not len(strings):
        return np.empty(0, np.uint64)
    data, off = _bytes_of(strings)
    if not len(data):
        return mix64(np.zeros(len(strings), np.uint64))
    return _spans(data, off[:-1], off[1:], False)


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of non-negative integers below 2**32: byte planes, so
    that small values cost little."""
    v = np.ascontiguousarray(values, dtype="<u4")
    return pa.Codec("zstd", compression_level=1).compress(v.view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def unpack(body: bytes, n: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(body, decompressed_size=4 * n, asbytes=True) if n else b""
    return np.frombuffer(raw, np.uint8).reshape(4, n).T.copy().view("<u4").reshape(n) if n else np.empty(0, "<u4")


def pack_strings(strings: pa.Array) -> tuple[bytes, bytes]:
    """(lengths in bytes, bodies) of strings, both compressed."""
    data, off = _bytes_of(strings)
    return pack(np.diff(off)), pa.Codec("zstd", compression_level=3).compress(data.tobytes(), asbytes=True)


def unpack_strings(lens: bytes, body: bytes, n: int) -> pa.Array:
    off = np.zeros(n + 1, np.int32)
    np.cumsum(unpack(lens, n), out=off[1:])
    raw = pa.Codec("zstd").decompress(body, decompressed_size=int(off[-1])) if off[-1] else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(n, pa.py_buffer(off), raw)


def runs(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes start..start+len-1 of each run, one after another."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)
