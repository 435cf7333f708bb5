"""Words and bytes of Arrow text columns as numpy arrays of 64-bit hashes.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; in UTF-8 these bytes
never occur inside another character, so this equals the split on characters.
Hashes are the same on every machine.  All functions work on one batch inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so powers have an inverse modulo 2**64
_powers = np.ones(1, dtype=U)
_inverse = np.ones(1, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


BYTE_HASH = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        up, down = np.full(size, _BASE, dtype=U), np.full(size, pow(_BASE, -1, 1 << 64), dtype=U)
        up[0] = down[0] = 1
        _powers, _inverse = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers, _inverse


def forget_powers() -> None:
    """Drops the tables of :func:`powers`, which are as long as the longest text met."""
    global _powers, _inverse
    _powers, _inverse = np.ones(1, dtype=U), np.ones(1, dtype=U)


def prefix_sums(tokens: np.ndarray) -> np.ndarray:
    """Sums from which :func:`spans_hash` takes the hash of any span of tokens."""
    up, _ = powers(len(tokens) + 1)
    sums = np.zeros(len(tokens) + 1, dtype=U)
    np.cumsum(tokens * up[: len(tokens)], out=sums[1:])
    return sums


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``[start, end)``, which depend on what the spans hold alone."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xD1B54A32D192ED03))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes of one text."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, bounds: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    start, end = word_bounds(data) if bounds is None else bounds
    return spans_hash(prefix_sums(BYTE_HASH[data]), start, end) if len(start) else np.zeros(0, dtype=U)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text, without a copy; a null is an empty text."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        part = part.cast(pa.large_binary()).fill_null(b"")
        if not len(part):
            continue
        _, offsets, data = part.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[part.offset: part.offset + len(part) + 1]
        held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield held[a:b]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
