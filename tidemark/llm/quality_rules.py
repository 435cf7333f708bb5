"""Quality rules: how far a document's character classes and common words are from its language's.

One pass over the texts makes a small row of counts per document.  The counts of all
documents that pass the base rules, summed by language, are that language's reference; a
document is rejected if the Jensen-Shannon distance of either histogram is too large for its
length and it is long enough to tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

from .tokens import lower_ascii, prefix_sums, spans_hash, texts_of, word_bounds, word_hashes

MIN_WORDS = 20
REPEAT_WORDS = 8
REPEAT_PERCENT = 30
#: Documents with fewer words are not judged by their histograms.
GUARD_WORDS = 60
#: Largest Jensen-Shannon distances (0 to 1) of a document that is kept: (a, b) stands for
#: a + b / sqrt(n_words).  The second part allows for the noise of a short sample, which falls
#: with the root of its length; the first for texts that differ from their language's average.
MOST_CHARS, MOST_WORDS = (0.16, 1.2), (0.1, 2.8)

SYMBOLS = b"#*$%&|<>"
# Frequent short words of each language, one histogram class each.
COMMON_WORDS = (
    "the of and to in a is that it for on was be with as by this from are or an at not which have but",
    "der die und in den das von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er",
    "de la le et les des en un du une que est pour qui dans par sur au pas plus ne se ce il sont avec",
    "de la que el en y a los se del las un por con no una su para es lo como más o pero sus al",
)


def _classes() -> np.ndarray:
    """The class of each byte; 0 for bytes inside a character."""
    of = np.zeros(256, np.int64)
    of[0x21:0x7F] = 9
    for k, members in enumerate((range(97, 123), range(65, 91), range(48, 58), b" ", b"\t\n\r\x0b\x0c", b".!?",
                                 b",;:", SYMBOLS), start=1):
        of[list(members)] = k
    of[0xC3] = 10  # most letters with accents
    of[[*range(0xC2, 0xC3), *range(0xC4, 0xF8)]] = 11
    of[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F]] = 12
    return of


_CLASS = _classes()
CHAR_CLASSES = 12
_LISTED = sorted({w for line in COMMON_WORDS for w in line.split()})
_HASHES = word_hashes(np.frombuffer(" ".join(_LISTED).encode(), np.uint8))
_ORDER = np.argsort(_HASHES)
WORD_CLASSES = len(_LISTED) + 1

COUNTS = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, n_chars long, chars array<long>, commons array<long>")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *(
    (c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")),
    ("chars", pa.list_(pa.int64())), ("commons", pa.list_(pa.int64()))])


def repeated_words(hashes: np.ndarray, size: int = REPEAT_WORDS) -> int:
    """Words inside windows of ``size`` words that are found at least twice."""
    n = len(hashes) - size + 1
    if n < 2:
        return 0
    at = np.arange(n)
    _, inverse, counts = np.unique(spans_hash(prefix_sums(hashes), at, at + size),
                                   return_inverse=True, return_counts=True)
    start = at[counts[inverse] > 1]
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[start] += 1
    edge[start + size] -= 1
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(data: np.ndarray) -> int:
    seen, count = set(), 0
    for line in data.tobytes().split(b"\n"):
        if line in seen:
            count += 1
        elif line.strip():  # only lines with a word are remembered
            seen.add(line)
    return count


def _count(data: np.ndarray) -> tuple:
    bounds = word_bounds(data)
    bytes_held = np.bincount(data, minlength=256)
    chars = np.bincount(_CLASS, weights=bytes_held, minlength=CHAR_CLASSES + 1).astype(np.int64)[1:]
    letters = int(bytes_held.sum() - bytes_held[0x80:0xC0].sum() - bytes_held[[0x20, *range(0x09, 0x0E)]].sum())
    lower = word_hashes(lower_ascii(data), bounds)
    place = np.minimum(np.searchsorted(_HASHES, lower, sorter=_ORDER), len(_LISTED) - 1)
    listed = np.where(_HASHES[_ORDER[place]] == lower, _ORDER[place], len(_LISTED))
    return (len(bounds[0]), letters, int(bytes_held[list(SYMBOLS)].sum()), duplicate_lines(data),
            repeated_words(word_hashes(data, bounds)), int(chars.sum()), chars, np.bincount(listed, minlength=WORD_CLASSES))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(k, lang, *_count(data)) for k, lang, data in zip(
            batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(),
            texts_of(batch.column("text")), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _distance(counts: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of counts with this total from a reference's shares."""
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    each = F.zip_with(F.transform(counts, lambda x: x / total), shares,
                      lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2)
    found = F.sqrt(F.greatest(F.aggregate(each, F.lit(0.0), lambda x, y: x + y), F.lit(0.0)))
    return F.coalesce(F.when(total > 0, found), F.lit(0.0))


def judge(docs: DataFrame) -> DataFrame:
    """One row of counts and verdicts for each row of ``docs`` (doc_id, text, lang).

    (doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance, kept).  Words are runs of anything but ASCII white space.
    ``base_failed``: under 20 words, or over 30 % of them in 8-word windows found twice.
    ``kept``: the base rules hold, and for texts of at least ``GUARD_WORDS`` words both
    distances are at most ``MOST_CHARS`` and ``MOST_WORDS``, which fall with the text's length.
    Documents without a language
    have a reference of their own, as has each language.  A null text has no words; a null
    doc_id stays null; repeated rows count each time; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text")
    scratch = Scratch(spark, "quality")
    counted = scratch(rows.mapInArrow(_run, COUNTS), "counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    sums = lambda c, n: F.array(*[F.sum(F.col(c)[i].cast("double")) for i in range(n)]).alias(c)
    summed = counted.where(~failed).groupBy("lang").agg(
        sums("chars", CHAR_CLASSES), sums("commons", WORD_CLASSES),
        F.sum(F.col("n_chars").cast("double")).alias("all_chars"), F.sum(F.col("n_words").cast("double")).alias("all_words"))
    # Stored, so that Spark knows how small it is before it plans the join.
    reference = scratch(summed.select(
        "lang", F.transform("chars", lambda x: x / F.col("all_chars")).alias("lang_chars"),
        F.transform("commons", lambda x: x / F.col("all_words")).alias("lang_commons")), "reference")
    met = counted.join(reference, "lang", "left")
    judged = (met.withColumn("base_failed", failed)
              .withColumn("char_distance", _distance(F.col("chars"), F.col("n_chars"), F.col("lang_chars")))
              .withColumn("word_distance", _distance(F.col("commons"), F.col("n_words"), F.col("lang_commons"))))
    most = lambda c: c[0] + c[1] / F.sqrt("n_words")
    far = (F.col("n_words") >= GUARD_WORDS) & (
        (F.col("char_distance") > most(MOST_CHARS)) | (F.col("word_distance") > most(MOST_WORDS)))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).drop(
        "n_chars", "chars", "commons", "lang_chars", "lang_commons")
