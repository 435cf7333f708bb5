"""Substring deduplication with suffix automata of reference shards.

Every document is a reference for the later ones, so a shard's automaton is not sent to all
documents: passages travel to the shard that can hold their match (``repeats``).  A passage
equal to one of an earlier document is settled on the way by its hash; the others meet the
automaton of their shard, which holds the passages of the earlier documents.  Streaming
gives the longest match that ends at each word (matching statistics); where it reaches the
threshold, the words that it covers go.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Plan, remove_repeats
from .tokens import word_hashes

MIN_WORDS = 50
GRAM_WORDS = 20
MOST_OPEN = 1000  # phrases of some 70 words that one automaton holds


class SuffixAutomaton:
    """Recognises all substrings of the sequences added; grows by one token at a time."""

    def __init__(self) -> None:
        self.edges: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.edges.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.edges) - 1

    def _split(self, p: int, token: int) -> int:
        """The state for ``p`` + token, cut from a longer one where needed."""
        edges, link, length = self.edges, self.link, self.length
        q = edges[p][token]
        if length[q] == length[p] + 1:
            return q
        copy = self._state(length[p] + 1, link[q], dict(edges[q]))
        link[q] = copy
        while p >= 0 and edges[p].get(token) == q:
            edges[p][token] = copy
            p = link[p]
        return copy

    def add(self, tokens: list[int]) -> None:
        edges, link, length = self.edges, self.link, self.length
        last = 0
        for token in tokens:
            if token in edges[last]:
                last = self._split(last, token)
                continue
            new, p = self._state(length[last] + 1, 0, {}), last
            while p >= 0 and token not in edges[p]:
                edges[p][token] = new
                p = link[p]
            if p >= 0:
                link[new] = self._split(p, token)
            last = new

    def matching_statistics(self, tokens: list[int]) -> list[int]:
        """For each token the length of the longest match that ends with it."""
        edges, link, length = self.edges, self.link, self.length
        state = size = 0
        out = []
        for token in tokens:
            while state and token not in edges[state]:
                state = link[state]
                size = length[state]
            if token in edges[state]:
                state = edges[state][token]
                size += 1
            out.append(size)
        return out


def _settle(width: int):
    def settle(values: np.ndarray, at: np.ndarray, ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
        counts = np.diff(at) - width + 1
        place = np.cumsum(counts) - counts
        hit = np.zeros(int(counts.sum()), bool)
        order = np.lexsort((ids, grams))
        gram, automaton, waiting, doc = None, SuffixAutomaton(), [], None
        for i in order.tolist():
            if grams[i] != gram:
                gram, automaton, waiting, doc = grams[i], SuffixAutomaton(), [], ids[i]
            elif ids[i] != doc:  # from here on the last document is an earlier one
                for tokens in waiting:
                    automaton.add(tokens)
                waiting, doc = [], ids[i]
            tokens = values[at[i]: at[i + 1]].tolist()
            if len(automaton.edges) > 1:
                size = np.array(automaton.matching_statistics(tokens)[width - 1:])
                hit[place[i]: place[i] + counts[i]] = size >= width
            waiting.append(tokens)
        return hit
    return settle


def _rest(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    words = data.tobytes().split()
    if not len(start):
        return len(words), 0, b" ".join(words)
    edges = zip([0, *end.tolist()], [*start.tolist(), len(words)], strict=True)
    kept = [w for a, b in edges for w in words[a:b]]
    return len(words), len(words) - len(kept), b" ".join(kept)


def plan(min_words: int = MIN_WORDS) -> Plan:
    return Plan(min_words, min(GRAM_WORDS, max(1, min_words // 2)), word_hashes, word_hashes, "u8",
                _settle(min_words), MOST_OPEN, _rest)


def remove_repeated_words(docs: DataFrame, min_words: int = MIN_WORDS, carry: tuple[str, ...] = (),
                          within: str | None = None) -> DataFrame:
    """Each row of (doc_id, text) without the words that an earlier document holds too.

    A word goes if a window of ``min_words`` words that covers it also starts in a row with a
    smaller doc_id; windows are judged on the input.  ``kept`` holds the words left, joined by
    one space; a word counts as equal if its 64-bit hash is.  A null text counts as empty; a
    null doc_id has no order, so its row stays whole; repeated rows (same doc_id) never remove
    each other.  Shorter texts stay, texts of any length are read whole, ``min_words`` is at most
    65,535; an empty table gives an empty one.  Columns in ``carry`` come back as they are, in a
    struct if ``within`` names one (then they may have any names); others are not read.
    """
    return remove_repeats(docs, plan(min_words), carry, within)
