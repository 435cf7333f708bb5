"""Suffix-array deduplication by prefix-free parsing.

Texts are parsed into phrases at triggers, the grams whose rolling hash is the least in a
window, so equal passages are parsed alike wherever they stand (``repeats``).  The distinct
phrases are the dictionary, the documents that hold them the parse.  The dictionary's
suffixes, as far as the threshold reaches, are sorted as bytes; each shard sorts the phrases
of its triggers, as equal suffixes have the same trigger.  With the least document of each
phrase from the parse, a run of equal suffixes is in corpus order: all but the first
document's copies go.  Phrases whose trigger has no second phrase have no neighbour in the
array that they could share a suffix with, so they are settled by the parse alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Plan, merged, remove_repeats
from .tokens import BYTE_HASH

MIN_BYTES = 50
TRIGGER_BYTES = 20
MOST_OPEN = 20_000  # phrases of some 31 suffixes that one array sorts


def suffix_order(text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` sorted by their first ``width`` bytes, and the sorted strings."""
    whole = np.lib.stride_tricks.sliding_window_view(text, width)[starts]
    keys = np.ascontiguousarray(whole).view(f"S{width}").ravel()
    order = np.argsort(keys, kind="stable")
    return order, keys[order]


def _settle(width: int):
    def settle(values: np.ndarray, at: np.ndarray, ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
        counts = np.diff(at) - width + 1
        of = np.repeat(np.arange(len(counts)), counts)
        starts = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + at[:-1][of]
        order, keys = suffix_order(values, starts, width)
        new = np.concatenate([[True], keys[1:] != keys[:-1]])  # elsewhere the common prefix is whole
        doc = ids[of][order]
        least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
        hit = np.zeros(len(of), bool)
        hit[order] = doc > least
        return hit
    return settle


def _rest(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    if not len(start):
        return len(data), 0, data.tobytes()
    edges = zip([0, *end.tolist()], [*start.tolist(), len(data)], strict=True)
    return len(data), int((end - start).sum()), b"".join(data[a:b].tobytes() for a, b in edges)


def _rest_of_characters(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    """The same with spans widened to whole characters."""
    inner = np.append((data & 0xC0) == 0x80, False)
    whole = np.flatnonzero(~inner)  # where characters start, and the end
    start = whole[np.searchsorted(whole, start, side="right") - 1]
    end = whole[np.searchsorted(whole, end)]
    return _rest(data, *merged(start, end))


def plan(min_bytes: int = MIN_BYTES, whole_characters: bool = False) -> Plan:
    return Plan(min_bytes, min(TRIGGER_BYTES, max(1, min_bytes // 2)), lambda b: BYTE_HASH[b], lambda b: b,
                "u1", _settle(min_bytes), MOST_OPEN, _rest_of_characters if whole_characters else _rest)


def remove_repeated_bytes(docs: DataFrame, min_bytes: int = MIN_BYTES, carry: tuple[str, ...] = (),
                          whole_characters: bool = False, within: str | None = None) -> DataFrame:
    """Each row of (doc_id, text) without the bytes that an earlier document holds too.

    A byte goes if a string of ``min_bytes`` bytes that covers it also starts in a row with a
    smaller doc_id.  Strings never cross rows and are judged on the input.  Returns the
    columns of :data:`repeats.KEPT` (``kept`` in bytes, which may end inside a character unless
    ``whole_characters`` takes the rest of such characters away too) and those in
    ``carry``, in a struct if ``within`` names one (then they may have any names); other columns
    are not read.  A null text counts as empty; a null doc_id has no order, so its row stays whole; repeated
    rows (same doc_id) never remove each other.  Texts shorter than ``min_bytes`` stay, texts of
    any length are read whole, ``min_bytes`` is at most 65,535; an empty table gives an empty one.
    """
    return remove_repeats(docs, plan(min_bytes, whole_characters), carry, within)
