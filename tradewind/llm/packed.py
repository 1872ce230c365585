"""Lists of numbers and of texts as small binary values, for tables that hold many of them in a row."""

from __future__ import annotations

import numpy as np
import zstandard

_squeeze, _expand = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
_squeeze_texts = zstandard.ZstdCompressor(level=9)
#: Numbers below take one byte; others take a byte with the bits above 16 (or ``_MORE``, and these bits apart), and two more.
_SMALL, _MORE = 192, 63


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers in few bytes, if most are small."""
    values = np.asarray(values, np.uint32)
    large = values[values >= _SMALL] - np.uint32(_SMALL)
    upper = large >> np.uint32(16)
    first = values.astype(np.uint8)
    first[values >= _SMALL] = _SMALL + np.minimum(upper, _MORE)
    streams = [first, large.astype(np.uint8), (large >> np.uint32(8)).astype(np.uint8), upper[upper >= _MORE].astype("<u2").view(np.uint8)]
    packed = [_squeeze.compress(s.tobytes()) for s in streams]
    return b"".join(len(p).to_bytes(4, "little") for p in packed) + b"".join(packed)


def unpack_numbers(data: bytes) -> np.ndarray:
    streams, at = [], 16
    for size in np.frombuffer(data, "<u4", 4).tolist():
        streams.append(np.frombuffer(_expand.decompress(data[at : at + size]), np.uint8))
        at += size
    values = streams[0].astype(np.uint32)
    large = values >= _SMALL
    upper = values[large] - np.uint32(_SMALL)
    upper[upper == _MORE] = streams[3].view("<u2")
    values[large] = _SMALL + streams[1].astype(np.uint32) + (streams[2].astype(np.uint32) << np.uint32(8)) + (upper << np.uint32(16))
    return values


def pack_texts(texts: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, texts), "<u4", len(texts))
    return len(texts).to_bytes(4, "little") + _squeeze_texts.compress(sizes.view(np.uint8).reshape(-1, 4).T.tobytes() + b"".join(texts))


def unpack_texts(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    raw = _expand.decompress(data[4:])
    sizes = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n).reshape(4, -1).T).view("<u4").ravel()
    ends = (4 * n + np.cumsum(sizes, dtype=np.int64)).tolist()
    return [raw[a:b] for a, b in zip([4 * n, *ends], ends)]  # noqa: B905
