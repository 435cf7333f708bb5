"""A minimal perfect hash of a fixed set of byte strings, looked up for many spans at once.

Hash and displace: keys fall into buckets of about four, and each bucket has a displacement
under which all its keys land on free slots, so n keys fill n slots without a gap.  Buckets of
one key name their slot directly.  A lookup is exact: it compares all bytes of the span with
the one key that its slot holds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from .tokens import U, mix

_SEED, _STEP = U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)
BUCKET_KEYS = 4
TRIALS = 16, 4096  # displacements tried at a time: at first, and at most


class Spans:
    """Spans of a byte array, read eight bytes at a time."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        padded = np.zeros(len(data) + 8, dtype=np.uint8)
        padded[: len(data)] = data
        self.words = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
        self.start, self.length = start, length

    def word(self, k: int, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Bytes 8k to 8k+7 of the spans, as one number each; bytes past the end are zero."""
        left = self.length[of] - 8 * k
        return self.words[self.start[of] + 8 * k] & _MASK[np.minimum(left, 8)]

    def hashes(self, longest: int) -> np.ndarray:
        """A hash of each span; spans over ``longest`` bytes are not read to their end."""
        h = mix(self.word(0) ^ (self.length.astype(U) * _SEED))
        for k in range(1, (longest + 7) // 8):
            more = np.flatnonzero(self.length > 8 * k)
            if not len(more):
                break
            h[more] = mix((h[more] + self.word(k, more)) ^ _STEP)
        return h


class PerfectHash:
    """``find`` gives the place of each span among ``keys``, or -1.  Keys are distinct, not empty."""

    def __init__(self, keys: Sequence[bytes]):
        self.n = len(keys)
        lengths = np.fromiter(map(len, keys), np.int64, self.n)
        self.longest = int(lengths.max(initial=0))
        start = np.cumsum(lengths) - lengths
        spans = Spans(np.frombuffer(b"".join(keys), np.uint8), start, lengths)
        h = spans.hashes(self.longest)
        if len(np.unique(h)) != self.n:
            raise ValueError("keys are not distinct")
        self.shift = np.zeros(self.n // BUCKET_KEYS + 1, dtype=np.int64)
        slot = self._place(h)
        order = np.empty(self.n, dtype=np.int64)
        order[slot] = np.arange(self.n)
        self.key = order  # the key that each slot holds
        self.length = lengths[order]
        self.first = spans.word(0)[order]
        self.spans = Spans(spans.words.base, start[order], self.length)

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> U(32)) % U(len(self.shift))).astype(np.int64)

    def _place(self, h: np.ndarray) -> np.ndarray:
        """Fills ``shift`` and gives the slot of each key, largest buckets first."""
        free = np.ones(self.n, dtype=bool)
        slot = np.zeros(self.n, dtype=np.int64)
        bucket = self._bucket(h)
        by_bucket = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=len(self.shift))
        begin = np.cumsum(size) - size
        largest_first = np.argsort(-size, kind="stable")
        for b in largest_first[size[largest_first] > 1].tolist():
            keys = by_bucket[begin[b]: begin[b] + size[b]]
            shift, trials = 0, TRIALS[0]
            while True:
                tried = np.arange(shift, shift + trials, dtype=np.int64)
                at = (mix(h[keys][None, :] + tried.astype(U)[:, None] * _STEP) % U(self.n)).astype(np.int64)
                fits = free[at].all(axis=1)
                if fits.any():
                    rows = np.sort(at[fits], axis=1)
                    apart = np.flatnonzero((rows[:, 1:] != rows[:, :-1]).all(axis=1))
                    if len(apart):
                        row = np.flatnonzero(fits)[apart[0]]
                        break
                shift, trials = shift + trials, min(4 * trials, TRIALS[1])
            self.shift[b] = tried[row]
            slot[keys] = at[row]
            free[at[row]] = False
        single = np.flatnonzero(size == 1)
        rest = np.flatnonzero(free)
        slot[by_bucket[begin[single]]] = rest
        self.shift[single] = -1 - rest
        return slot

    def find(self, spans: Spans) -> np.ndarray:
        if not self.n:
            return np.full(len(spans.start), -1)
        h = spans.hashes(self.longest)
        shift = self.shift[self._bucket(h)]
        slot = np.where(shift < 0, -1 - shift, (mix(h + shift.astype(U) * _STEP) % U(self.n)).astype(np.int64))
        same = (self.length[slot] == spans.length) & (self.first[slot] == spans.word(0))
        for k in range(1, (self.longest + 7) // 8):
            more = np.flatnonzero(same & (spans.length > 8 * k))
            if not len(more):
                break
            same[more] = spans.word(k, more) == self.spans.word(k, slot[more])
        return np.where(same, self.key[slot], -1)
