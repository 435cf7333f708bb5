"""Best-fit-decreasing packing of tokenized documents into sequences of a fixed length.

Best fit only asks for lengths, of which there are at most ``capacity``; so the driver packs
the *histogram* of lengths (a bounded table) and Spark deals the pieces to the plan.  Open
bins with the same free space are kept as ranges of bin numbers under a segment tree over
the free spaces, which finds the tightest one that fits.  A length's pieces fill ranges at
once, so the plan has a few thousand rows whatever the number of documents.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

from .worker import begin, kept

CAPACITY = 4096
END_ID = 1
#: Words kept by a Python worker with their packed ids (about 200 bytes each), per generation
#: (there are two), and the longest of them.
KEPT_WORDS = 300_000
KEPT_CHARS = 64


class FreeSpace:
    """Segment tree over free spaces 0..capacity: how many ranges of bins have each."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.held = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _count(self, space: int, by: int) -> None:
        i = space + self.leaves
        while i:
            self.held[i] += by
            i //= 2

    def put(self, space: int, first: int, end: int) -> None:
        """Bins first..end-1 now have this free space."""
        if first < end and space > 0:
            self.ranges[space].append((first, end))
            self._count(space, 1)

    def tightest(self, need: int) -> int | None:
        """The least free space of at least ``need`` that any bin has."""
        i = need + self.leaves
        if self.held[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.held[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.held[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None

    def take(self, space: int) -> tuple[int, int]:
        self._count(space, -1)
        return self.ranges[space].pop()


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, end, bin, per_bin, offset): pieces first..end-1 of a length, numbered
    from 0, go ``per_bin`` to a bin from ``bin`` on, the first of each at ``offset``."""
    free, plan, bins = FreeSpace(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        done, count = 0, histogram[length]
        while done < count:
            space = free.tightest(length)
            if space is None:
                space = capacity
                first, end = bins, bins + -(-(count - done) // (capacity // length))
                bins = end
            else:
                first, end = free.take(space)
            per_bin = space // length
            full = min(end - first, (count - done) // per_bin)
            offset = capacity - space
            if full:
                plan.append((length, done, done + full * per_bin, first, per_bin, offset))
                done += full * per_bin
                free.put(space - per_bin * length, first, first + full)
            rest = first + full
            if rest < end and done < count:  # the last bin gets what is left
                plan.append((length, done, count, rest, per_bin, offset))
                free.put(space - (count - done) * length, rest, rest + 1)
                done, rest = count, rest + 1
            free.put(space, rest, end)
    return plan


# ---- tokens -------------------------------------------------------------------------

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: What the pattern of the known tokenizers matches in a text of these characters alone.
_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^ \\t-\\r0-9{LETTERS}]+")
_OTHER = re.compile(f"[^\\x00-\\x7f{LETTERS}]|<\\|")
#: Fixed values of the tokenizer file: the parts that :class:`PackedIds` relies on.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PackedIds(dict):
    """Ids of texts as little-endian 32-bit numbers, by way of kept words.

    Texts of ASCII and Latin-1 letters are lower-cased and cut by the tokenizer's pattern
    here; its merges then see each distinct part once.  Other texts, and other tokenizers,
    go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.shown = _byte_characters()
        self.older: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        steps = [n["type"] for n in (said["normalizer"] or {}).get("normalizers", [])]
        split = ((said["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.known = (steps == _NORMALIZERS and split.get("pattern") == {"Regex": _PATTERN}
                      and all(t["content"].startswith("<|") for t in said["added_tokens"]))

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            spelled = word if word.isascii() and word.isalpha() else "".join(
                map(self.shown.__getitem__, word.encode()))
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        if len(word) <= KEPT_CHARS:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not self.known or _OTHER.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return b"".join([i.to_bytes(4, "little") for i in ids])
        if len(self) > KEPT_WORDS:  # words met again move on, the rest are forgotten
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, _TOKENS.findall(text.lower())))


@kept
def packed_ids(path: str) -> PackedIds:
    return PackedIds(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                           ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each row of ``docs`` (doc_id, text); see :func:`pack`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of = packed_ids(tokenizer).of
        end_id = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = ids_of(text.as_py() or "") + end_id
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a: a + 4 * capacity]
                    rows.append((key, k, a // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES_ARROW.types, strict=True)],
                    schema=_PIECES_ARROW)
        packed_ids(tokenizer).older.clear()  # a worker keeps one generation between tasks

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place in sequences of ``capacity`` tokens.

    A document is its ids and an end id; a null or empty text is the end id alone.  Longer
    documents are cut into pieces of ``capacity`` ids, the last one shorter.  Returns
    (doc_id, piece, start, length, ids_crc32, sequence_id, offset); each sequence is filled
    from offset 0 without gaps.  Equal lengths are dealt in the order of doc_id and piece.
    A null doc_id is packed like any other, repeated rows are packed each time, an empty
    table gives an empty one.  ``tokenizer`` is a path on every worker.
    """
    spark = docs.sparkSession
    found = Scratch(spark, "packing")(pieces(docs, tokenizer, capacity), "pieces")
    # A length that a third of all pieces have is numbered in many parts.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit_plan(histogram, capacity)
    plan_df = spark.createDataFrame(plan, "length long, first long, end long, bin long, per_bin long, base long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")
                             .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1
    placed = (dealt.withColumn("inside", inside).join(starts, ["length", "part"])
              .withColumn("place", F.col("before") + F.col("inside")).alias("p"))
    # The plan's rows depend on the capacity, not on the documents: always fit to be sent.
    met = placed.join(F.broadcast(plan_df).alias("q"), [
        F.col("p.length") == F.col("q.length"), F.col("place") >= F.col("first"), F.col("place") < F.col("end")])
    nth = F.col("place") - F.col("first")
    return met.select(
        "doc_id", "piece", "start", "p.length", "ids_crc32",
        (F.col("bin") + F.floor(nth / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("per_bin")) * F.col("p.length")).cast("long").alias("offset"))
