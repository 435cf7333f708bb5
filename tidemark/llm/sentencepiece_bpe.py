"""SentencePiece encoding with a merge-type vocabulary, and decoding.

A text's symbols are merged pair by pair: an agenda ordered by score (then from the left)
holds the adjacent pairs that the vocabulary knows.  No piece reaches from another character
into a word mark, so a text is encoded word by word and the results of short words are kept.
New words are checked against the library in each Arrow batch, all in one call.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .worker import begin, kept

MARK = "▁"
#: Words of one generation kept by a Python worker with their ids (about 250 bytes each; there
#: are two generations), and the longest of them.
KEPT_WORDS = 500_000
KEPT_CHARS = 48

CONTROL, UNKNOWN, BYTE = 3, 2, 6  # fixed values of the model file's piece types


class Vocabulary:
    """A merge-type model file: its pieces, and the library that checks them."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        norm = model.normalizer_spec
        if (model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
                or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only merge-type vocabularies with byte fallback and plain text are supported")
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type not in (CONTROL, UNKNOWN, BYTE)}
        best = {x: r for r, x in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.ranks = {p: best[model.pieces[i].score] for p, i in self.ids.items()}
        self.bytes = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece, 16) if p.piece.startswith("0x") else int(p.piece[1:-1], 16)] = i
        if any(MARK in p[1:] and p.strip(MARK) for p in self.ids):
            raise ValueError("a piece reaches over a word mark")
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, word: str) -> list[str]:
        """Pieces of a word (marks first, then other characters) by an agenda of pairs.

        An agenda entry is the pair's rank by score and its place in one whole number, and
        is out of date once ``due`` holds another entry for the place.
        """
        n = len(word)
        if n < 2:
            return [word]
        rank = self.ranks.get
        piece, due = list(word), [-1] * n
        agenda = []
        for i in range(n - 1):
            if (r := rank(word[i:i + 2])) is not None:
                due[i] = r * n + i
                agenda.append(due[i])
        if not agenda:
            return piece
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            entry = heappop(agenda)
            i = entry % n
            if due[i] != entry:
                continue
            j = after[i]
            joined = piece[i] = piece[i] + piece[j]
            piece[j], due[i], due[j] = "", -1, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(joined + piece[k])) is not None:
                    due[i] = r * n + i
                    heappush(agenda, due[i])
            h = before[i]
            if h >= 0:
                if (r := rank(piece[h] + joined)) is None:
                    due[h] = -1
                else:
                    due[h] = r * n + h
                    heappush(agenda, due[h])
        return [p for p in piece if p]

    def encode_word(self, word: str) -> list[int]:
        out = []
        for p in self.merge(word):
            i = self.ids.get(p)
            if i is None:  # a character that the vocabulary lacks
                out += [self.bytes[b] for b in p.encode()]
            else:
                out.append(i)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, as the library gives them."""
        split = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.words) > KEPT_WORDS:  # words met again move on, the rest are forgotten
            self.words, self.older = {}, self.words
        known, older = self.words, self.older
        new = []
        for w in set(chain.from_iterable(split)).difference(known):
            if w in older:
                known[w] = older[w]
            else:
                new.append(w)
        long = {}
        for start in range(0, len(new), 50_000):
            part = new[start: start + 50_000]
            # Each word starts with the mark that the library itself puts before a text.
            checks = self.library.encode([w[1:].replace(MARK, " ") for w in part], num_threads=1)
            for w, check in zip(part, checks, strict=True):
                ids = self.encode_word(w)
                if ids != check and w != MARK:
                    raise AssertionError(f"{w!r}: {ids}, the library says {check}")
                (known if len(w) <= KEPT_CHARS else long)[w] = tuple(ids)
        out = []
        for words in split:
            try:
                out.append(list(chain.from_iterable(map(known.__getitem__, words))))
            except KeyError:
                out.append([i for w in words for i in (known[w] if w in known else long[w])])
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


@kept
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


ENCODED = "doc_id long, n_tokens long, ids string, decoded string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_string()),
                     ("decoded", pa.large_string())])
BATCH_CHARS = 4_000_000


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for each row of ``docs`` (doc_id, text).

    ``ids`` are the ids that the sentencepiece library gives for the whole text, in decimal
    and joined by commas, without begin or end; ``decoded`` is what they decode to.  A null
    text counts as empty and has no ids; a null doc_id stays null; repeated rows give
    repeated rows; an empty table gives an empty one.  ``model`` is a path on every worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        v = vocabulary(model)
        text_of = [str(i) for i in range(v.library.get_piece_size())].__getitem__
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = batch.column("doc_id").cast(pa.int64())
            start = 0
            while start < len(texts):  # a few MB at a time
                end, size = start, 0
                while end < len(texts) and (end == start or size < BATCH_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                ids = v.encode([t or "" for t in texts[start:end]])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, end - start), pa.array(map(len, ids), pa.int64()),
                     pa.array([",".join(map(text_of, x)) for x in ids], pa.large_string()),
                     pa.array(v.decode(ids), pa.large_string())], schema=_SCHEMA)
                start = end

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)
