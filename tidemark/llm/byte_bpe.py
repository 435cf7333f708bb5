"""Byte-level BPE encoding by a file of ranks, and decoding.

A text is cut into pre-tokens; each is looked up among the vocabulary's strings through a
minimal perfect hash, all of a few MB at a time.  What the vocabulary holds whole is one id.
The misses are merged byte by byte: a heap over the linked bytes gives the adjacent pair of
least rank, the leftmost of equals.  Merged misses are kept for the next batches.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .perfect_hash import PerfectHash, Spans
from .tokens import texts_of
from .worker import begin, kept

#: Misses of one generation kept by a Python worker with their ids (about 250 bytes each; there
#: are two generations), and the longest of them in bytes.
KEPT_MISSES = 400_000
KEPT_BYTES = 64
#: Bytes of text encoded at a time.  A longer text is encoded in blocks cut before a space.
BLOCK_BYTES = 2_000_000

LETTER, NUMBER, SPACE, OTHER = range(4)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point, as the regex library (and the rank files' own) has it."""
    import regex

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a: b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def pre_tokens(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True at each code point that starts a pre-token; ``first`` marks the starts of texts.

    The matches of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    by what they come to: runs of one class, each taking the space before it; white space
    before something else gives up its last character; and contractions, where an apostrophe
    is a run of its own that has no space before it.
    """
    n = len(cp)
    kind = classes()[cp]
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    start = change.copy()
    space = kind == SPACE
    run = np.flatnonzero(change & ~space & ~first)  # these follow something in their text
    start[run[cp[run - 1] == 32]] = False
    start[run[space[run - 1]] - 1] = True
    quote = np.flatnonzero(start & (cp == 39))
    if len(quote):
        padded = np.concatenate([cp, np.zeros(3, cp.dtype)])
        new_text = np.concatenate([first, np.ones(3, bool)])
        a = np.where(new_text[quote + 1], 0, padded[quote + 1])
        b = np.where((a == 0) | new_text[quote + 2], 0, padded[quote + 2])
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        start[quote[one | two] + 1] = False
        after = np.concatenate([quote[one] + 2, quote[two] + 3])
        start[after[after < n]] = True
    return start


class Ranks:
    """A rank file: lines of a base64 string and its rank, which is also its id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if not all(bytes([i]) in self.ranks for i in range(256)):
            raise ValueError("a vocabulary for bytes needs all 256 of them")
        self.strings = {i: s for s, i in self.ranks.items()}
        keys = list(self.ranks)
        self.table = PerfectHash(keys)
        self.id_of = np.fromiter((self.ranks[k] for k in keys), np.uint32, len(keys))
        self.kept: dict[bytes, tuple[int, ...]] = {}
        self.older: dict[bytes, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of a pre-token.

        A symbol is named by its first byte: ``end`` is where the next one starts and
        ``before`` where the last one did.  A heap entry is the rank of a symbol joined with
        the next and the symbol's place in one number; it is out of date once ``due`` has
        another for the place.
        """
        n, rank = len(word), self.ranks.get
        end, before, due = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
        heap = []
        for i in range(n - 1):
            if (r := rank(word[i:i + 2])) is not None:
                due[i] = r * n + i
                heap.append(due[i])
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry % n
            if due[i] != entry:
                continue
            j = end[i]
            k = end[i] = end[j]
            due[i] = due[j] = -1
            if k < n:
                before[k] = i
                if (r := rank(word[i:end[k]])) is not None:
                    due[i] = r * n + i
                    heappush(heap, due[i])
            h = before[i]
            if h >= 0:
                if (r := rank(word[h:k])) is None:
                    due[h] = -1
                else:
                    due[h] = r * n + h
                    heappush(heap, due[h])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i:end[i]]])
            i = end[i]
        return tuple(out)

    def misses(self, words: list[bytes]) -> list[tuple[int, ...]]:
        if len(self.kept) > KEPT_MISSES:  # those met again move on, the rest are forgotten
            self.kept, self.older = {}, self.kept
        kept, older, long = self.kept, self.older, {}
        for w in set(words).difference(kept):
            if w in older:
                kept[w] = older[w]
            else:
                (kept if len(w) <= KEPT_BYTES else long)[w] = self.merge(w)
        if long:
            return [kept[w] if w in kept else long[w] for w in words]
        return [kept[w] for w in words]

    def encode(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of each text, given as UTF-8 bytes; the texts are a few MB together."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        if not sizes.sum():
            return [np.zeros(0, np.uint32)] * len(texts)
        data = np.concatenate(texts)
        raw = data.tobytes()
        if data.max() < 128:
            cp, at = data.astype(np.uint32), np.arange(len(data) + 1)
        else:
            cp = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
            at = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.zeros(len(data), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        start = at[: len(cp)][pre_tokens(cp, first[at[: len(cp)]])]
        length = np.diff(start, append=len(data))
        spans = Spans(data, start, length)
        found = self.table.find(spans)
        hit, miss = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
        count = np.ones(len(start), dtype=np.int64)
        merged = self.misses([raw[a:b] for a, b in zip(start[miss].tolist(), (start[miss] + length[miss]).tolist(),
                                                       strict=True)])
        parts = np.fromiter(map(len, merged), np.int64, len(merged))
        count[miss] = parts
        place = np.cumsum(count) - count
        ids = np.empty(int(count.sum()), dtype="<u4")
        ids[place[hit]] = self.id_of[found[hit]]
        ids[np.repeat(place[miss] - (np.cumsum(parts) - parts), parts) + np.arange(parts.sum())] = np.fromiter(
            chain.from_iterable(merged), np.uint32, int(parts.sum()))
        upto = np.concatenate([[0], np.cumsum(count)])
        bound = upto[np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))]
        return [ids[a:b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids.tolist()))


def blocks(text: np.ndarray) -> list[np.ndarray]:
    """A text in blocks of about ``BLOCK_BYTES``, cut before spaces that follow a visible
    ASCII character: a pre-token starts there whatever comes next.  Without one it stays whole."""
    if len(text) <= BLOCK_BYTES:
        return [text]
    before = (text[:-1] > 32) & (text[:-1] < 127) & (text[1:] == 32)
    cuts = np.flatnonzero(before) + 1
    out, a = [], 0
    while len(text) - a > BLOCK_BYTES:
        i = np.searchsorted(cuts, a + BLOCK_BYTES, side="right")
        if i and cuts[i - 1] > a:
            b = int(cuts[i - 1])
        elif i < len(cuts):
            b = int(cuts[i])
        else:
            break
        out.append(text[a:b])
        a = b
    return [*out, text[a:]]


@kept
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def _encoded(v: Ranks, column: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each text of a column, a few MB at a time."""
    held: list[list[np.ndarray]] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        parts = iter(v.encode([b for text in held for b in text]))
        for text in held:
            ids = [next(parts) for _ in text]
            yield ids[0] if len(ids) == 1 else np.concatenate(ids)

    for text in texts_of(column):
        if len(text) > BLOCK_BYTES:
            yield from flush()
            held, size = [], 0
            yield np.concatenate([v.encode([b])[0] for b in blocks(text)])
            continue
        held.append([text])
        size += len(text)
        if size >= BLOCK_BYTES:
            yield from flush()
            held, size = [], 0
    yield from flush()


#: Bytes of ids and text given back in one Arrow batch, about.
BATCH_BYTES = 8_000_000


def _batches(keys: pa.Array, ids: Iterator[np.ndarray], v: Ranks, decoded: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_tokens", "ids", *(["decoded"] if decoded else [])]
    start, size, held, texts = 0, 0, [], []

    def batch() -> pa.RecordBatch:
        columns = [keys.slice(start, len(held)), pa.array([len(x) // 4 for x in held], pa.int64()),
                   pa.array(held, pa.large_binary())]
        return pa.RecordBatch.from_arrays(
            columns + ([pa.array(texts, pa.large_binary())] if decoded else []), names)

    for x in ids:
        held.append(x.tobytes())
        size += len(held[-1])
        if decoded:
            texts.append(v.decode(x))
            size += len(texts[-1])
        if size >= BATCH_BYTES:
            yield batch()
            start, size, held, texts = start + len(held), 0, [], []
    if held:
        yield batch()


def _encode(docs: DataFrame, ranks: str, decoded: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        v = ranks_of(ranks)
        for b in batches:
            if b.num_rows:
                yield from _batches(b.column("doc_id").cast(pa.int64()), _encoded(v, b.column("text")), v, decoded)

    schema = "doc_id long, n_tokens long, ids binary" + (", decoded binary" if decoded else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of ``docs`` (doc_id, text).

    ``ids`` are the whole text's ids, one little-endian unsigned 32-bit number after the
    other, as token files hold them.  Each pre-token is encoded by itself, without special
    tokens.  A null text counts as empty and has no ids; a null doc_id stays null; repeated
    rows give repeated rows; an empty table gives an empty one; other columns of ``docs`` are
    not read, whatever their names.  A text of any length is encoded whole, in blocks of a few
    MB; only a single pre-token, which is merged in one piece, needs memory of its own (some
    200 times its bytes).  ``ranks`` is a path on every worker.
    """
    return _encode(docs, ranks, decoded=False)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, decoded) for each row of ``encoded`` (doc_id, ids): the bytes that the ids
    stand for.  Null ids give no bytes; an unknown id ends the job with a KeyError."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        v = ranks_of(ranks)
        for b in batches:
            texts = [v.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(texts, pa.large_binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def encode_and_decode(docs: DataFrame, ranks: str) -> DataFrame:
    """:func:`encode` and, from its ids, ``decoded`` as :func:`decode` gives it, in one pass."""
    return _encode(docs, ranks, decoded=True)
