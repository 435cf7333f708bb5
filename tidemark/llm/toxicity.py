"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding undoes case, accents, homoglyphs and digits that stand for letters.  The lexicon
holds parts of words that are telling in labelled rows; hits inside an exception phrase do
not count.  A document's score is a logistic function of its hits per 1,000 characters.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .worker import begin

#: Bounds of the labelled sample that the lexicon is learned from.
TOXIC_ROWS, CLEAN_ROWS, LONGEST_TEXT = 1500, 3000, 20_000
MAX_TERMS = 200
TERM_SIZES = range(4, 10)

# Characters that look like Latin letters, and digits and signs written for them.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l",
    "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(c): None for c in INVISIBLE}
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if plain.isascii() and plain:
            table[code] = plain
    table |= {code: None for code in range(0x0300, 0x0370)}  # accents written on their own
    return table | {ord(c): s for c, s in (HOMOGLYPHS | SUBSTITUTES).items()}


_FOLD = _table()


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


@dataclass(frozen=True)
class Lexicon:
    terms: tuple[str, ...]
    weights: tuple[float, ...]
    exceptions: tuple[str, ...]
    bias: float


class Matcher:
    def __init__(self, terms: tuple[str, ...], exceptions: tuple[str, ...]):
        import ahocorasick

        self.size = len(terms)
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate([*terms, *(e for e in exceptions if e not in terms)]):
            self.automaton.add_word(t, (i, len(t)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> Counter:
        """How often each term occurs outside exception phrases."""
        if not len(self.automaton):
            return Counter()
        found = [(end - n + 1, end + 1, i) for end, (i, n) in self.automaton.iter(folded)]
        spared = [(a, b) for a, b, i in found if i >= self.size]
        if spared:
            inside = np.zeros(len(folded) + 1, np.int32)
            for a, b in spared:
                inside[a:b] = 1
            total = np.concatenate([[0], np.cumsum(inside)])
            found = [(a, b, i) for a, b, i in found if total[b] - total[a] < b - a]
        return Counter(i for _, _, i in found if i < self.size)

    def rates(self, text: str | None) -> tuple[dict[int, float], int]:
        """Logarithm of 1 + hits per 1,000 characters of each term found; all hits."""
        folded = fold(text or "")
        found = self.hits(folded)
        per = 1000 / max(len(folded), 200)
        return {i: math.log1p(n * per) for i, n in found.items()}, sum(found.values())


def _parts(folded: str) -> set[str]:
    words = {w for w in "".join(c if c.isalpha() else " " for c in folded).split() if len(w) >= TERM_SIZES[0]}
    return {w[i:i + n] for w in words for n in TERM_SIZES for i in range(len(w) - n + 1)}


def _telling(toxic: list[str], clean: list[str]) -> tuple[list[str], list[str]]:
    """Word parts found in many more toxic texts than clean ones, and longer phrases around
    them that are found in clean texts only."""
    a, b = Counter(), Counter()
    for t in toxic:
        a.update(_parts(t))
    a = Counter({p: n for p, n in a.items() if n >= 4})
    for t in clean:
        b.update(_parts(t))
    scored = []
    for p, n in a.items():  # cautious shares: below what was seen in toxic texts, above in clean
        x = (n - 1.5 * math.sqrt(n)) / len(toxic)
        y = (b[p] + 1.5 * math.sqrt(b[p] + 1)) / len(clean)
        if x > 2 * y:
            scored.append((n * math.log(x / y), len(p), p))
    terms: list[str] = []
    for _, _, p in sorted(scored, reverse=True)[: 40 * MAX_TERMS]:
        if len(terms) == MAX_TERMS:
            break
        # A part and a longer one are both kept if they are found in different texts.
        if not any((p in t or t in p) and 4 * abs(a[p] - a[t]) < max(a[p], a[t]) for t in terms):
            terms.append(p)
    rare = [p for p, n in b.items() if n >= max(5, len(clean) // 200) and not a[p] and len(p) > TERM_SIZES[0]]
    return terms, [p for p in rare if any(t in p for t in terms)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (the last is the bias) by Newton steps on the penalised likelihood."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty),
                               x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text).

    From a bounded sample: of the rows with least hash of doc_id at most ``TOXIC_ROWS`` toxic
    and ``CLEAN_ROWS`` others, those with at most ``LONGEST_TEXT`` characters.  The bias is set
    to the share of toxic rows among all labels given.  Null labels, ids and texts are left
    out; without rows of both kinds the lexicon is empty and its score is that share.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    total = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    share = ((total.toxic or 0) + 0.5) / (total.n + 1)
    bias = math.log(share / (1 - share))
    drawn = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for k, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    drawn = F.broadcast(drawn[0].unionByName(drawn[1]))  # two short columns of 4,500 rows at most
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .where(F.length("text") <= LONGEST_TEXT).join(drawn, "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # one row where a doc_id is repeated
            .collect())
    rows = sorted(((r.doc_id, fold(r.text), r.toxic) for r in rows))[: TOXIC_ROWS + CLEAN_ROWS]
    toxic, clean = ([t for _, t, y in rows if y == k] for k in (1, 0))
    if not toxic or not clean:
        return Lexicon((), (), (), bias)
    terms, exceptions = _telling(toxic, clean)
    matcher = Matcher(tuple(terms), tuple(exceptions))
    x = np.zeros((len(rows), len(terms)))
    for r, (_, t, _) in enumerate(rows):
        for i, v in matcher.rates(t)[0].items():
            x[r, i] = v
    w = _logistic(x, np.array([y for *_, y in rows], float))
    drawn_share = len(toxic) / len(rows)
    return Lexicon(tuple(terms), tuple(w[:-1].tolist()), tuple(exceptions),
                   float(w[-1]) + bias - math.log(drawn_share / (1 - drawn_share)))


def scorer(lexicon: Lexicon) -> Callable[[Column], Column]:
    """What makes a struct (score, hits) of a column of texts; only the texts go to Python."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin(__name__)
        matcher = Matcher(lexicon.terms, lexicon.exceptions)
        for batch in texts:
            scores, hits = [], []
            for text in batch:
                found, n = matcher.rates(text.as_py())
                z = lexicon.bias + sum(lexicon.weights[i] * v for i, v in found.items())
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                hits.append(n)
            yield pa.StructArray.from_arrays(
                [pa.array(scores, pa.float64()), pa.array(hits, pa.int64())], names=["score", "hits"])

    return F.arrow_udf(run, "score double, hits long")


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with toxic_score (0 to 1) and toxic_hits of its column ``text``.

    A null or empty text has no hits and so the lexicon's least score but for negative
    weights; repeated rows score alike; an empty table gives an empty one.  Texts are scored
    whole, however long.  Other columns are passed through; columns with the two names are
    replaced (:func:`scorer` takes and gives columns without names of its own).
    """
    told = scorer(lexicon)(F.col("text"))
    names = docs.drop("toxic_score", "toxic_hits").columns
    return (docs.select(*[F.col(f"`{c}`") for c in names], told.alias("toxic_score"))
            .select(*[F.col(f"`{c}`") for c in names], F.col("toxic_score.score").alias("toxic_score"),
                    F.col("toxic_score.hits").alias("toxic_hits")))
