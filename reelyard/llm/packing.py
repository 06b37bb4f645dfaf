"""Compact integer arrays in binary columns, for rows that carry many small numbers through a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ZSTD = "zstd"


def press(data: bytes, level: int = 3) -> bytes:
    return pa.Codec(_ZSTD, compression_level=level).compress(data, asbytes=True)


def unpress(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, _ZSTD, asbytes=True)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers: their width in one byte, how many, then planes of equal significance, compressed."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + len(values).to_bytes(8, "little") + press(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    """The packed integers: int64, or uint64 where they need eight bytes."""
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(unpress(data[9:], width * n), np.uint8).reshape(width, n)
    out = np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1)
    return out if width == 8 else out.astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


#: Ranks below this take one byte; the other first bytes stand for the higher bits of larger ranks.
_SHORT = 192
MAX_RANK = (256 - _SHORT) << 16


def pack_ranks(ranks: np.ndarray) -> bytes:
    """Frequency ranks (small numbers are common), below ``MAX_RANK``: first bytes, then two more where needed."""
    if len(ranks) and int(ranks.max()) >= MAX_RANK:
        return b"\0" + pack(ranks)
    short = ranks < _SHORT
    head = np.where(short, ranks, _SHORT + (ranks >> 16)).astype(np.uint8)
    rest = ranks[~short].astype(np.uint16)
    parts = [press(x.tobytes()) for x in (head, (rest >> 8).astype(np.uint8), rest.astype(np.uint8))]
    sizes = np.array([len(ranks), len(rest), len(parts[0]), len(parts[1])], dtype="<i8")
    return b"\1" + sizes.tobytes() + b"".join(parts)


def unpack_ranks(data: bytes) -> np.ndarray:
    if data[0] == 0:
        return unpack(data[1:])
    n, m, a, b = np.frombuffer(data[1:33], dtype="<i8").tolist()
    at = 33
    out = np.frombuffer(unpress(data[at : at + a], n), np.uint8).astype(np.int64)
    high, low = (np.frombuffer(unpress(x, m), np.uint8).astype(np.int64) for x in (data[at + a : at + a + b], data[at + a + b :]))
    large = out >= _SHORT
    out[large] = (out[large] - _SHORT) << 16 | high << 8 | low
    return out
