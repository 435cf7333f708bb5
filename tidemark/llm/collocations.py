"""Phrase collocation mining: which words stand together more often than apart.

Phrases grow a word at a time.  For each length, every place where a phrase of that length
starts is a suffix pointer, unless the phrase without its first or its last word is known to
be infrequent.  Pointers to equal phrases of a few MB of text are made one entry with a count
and routed by their leading words' hash, so a phrase that a third of all texts hold is one
entry per flush of a task.  A shard sorts its pointers by multikey three-way quicksort to the
full depth: the sizes of the equal partitions are the phrases' counts, and a partition that
falls below the least count is abandoned.

Words are compared by 64-bit hashes of (language, word).  The table of all words, which is
made first, shows whether two of them share a hash; if so another salt is taken, so counts
are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

from .tokens import BYTE_HASH, U, lower_ascii, mix, prefix_sums, spans_hash, texts_of
from .worker import begin, release

CHUNK_BYTES = 1 << 20
#: Pointers or words held by a map task before they are made entries and sent.
FLUSH = 700_000
#: Entries of a shard, about, before equal phrases of different tasks meet.
SHARD_ENTRIES = 1 << 20
#: Bits for the frequent phrases of the length before: 8 for each, up to 64 MB in all.  Where
#: there are more phrases, infrequent ones are found out later, in their shard.
FILTER_BITS = 8
MOST_BITS = 1 << 29
SEGMENT_BITS = 1 << 20

_SPLIT = np.zeros(256, dtype=bool)  # between pieces
_SPLIT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_SPLIT
_WORD[[0x20, 0x09]] = False
_FOLD = U(0x9FB21C651E98DF25)


def fold(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of hashes."""
    out = mix(columns[0])
    for c in columns[1:]:
        out = mix(out * _FOLD + c)
    return out


class Words:
    """The words of a chunk of texts in order: hashes, places, and which start pointers."""

    def __init__(self, blocks: list[tuple[np.ndarray, int, int]], salt: int):
        """``blocks``: bytes, up to where a word may start a pointer, hash of the language."""
        table = mix(BYTE_HASH + U(salt))
        sizes = np.array([len(b) + 1 for b, _, _ in blocks])
        self.data = np.full(int(sizes.sum()), 10, dtype=np.uint8)  # a line end after each block
        begin = np.cumsum(sizes) - sizes
        for (b, _, _), at in zip(blocks, begin.tolist(), strict=True):
            self.data[at: at + len(b)] = b
        self.data = lower_ascii(self.data)
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[1:] = _WORD[self.data]
        step = np.diff(inside)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        block = np.searchsorted(begin, self.start, side="right") - 1
        lang = np.array([h for _, _, h in blocks], dtype=U)
        plain = spans_hash(prefix_sums(table[self.data]), self.start, self.end) if len(self.start) else np.zeros(0, U)
        self.block = block
        self.hash = mix(plain + lang[block])
        splits = np.cumsum(_SPLIT[self.data])
        self.joined = np.zeros(len(self.start), dtype=bool)  # the next word is in the same piece
        self.joined[:-1] = splits[self.start[1:]] == splits[self.end[:-1] - 1]
        self.emits = self.start < (begin + np.array([e for _, e, _ in blocks]))[block]

    def starts(self, width: int) -> np.ndarray:
        """Whether a phrase of ``width`` words starts at each word."""
        n = len(self.hash)
        out = np.zeros(n, dtype=bool)
        if n >= width:
            out[: n - width + 1] = True
            for k in range(width - 1):
                out[: n - width + 1] &= self.joined[k: n - width + 1 + k]
        return out

    def columns(self, at: np.ndarray, width: int) -> list[np.ndarray]:
        return [self.hash[at + k] for k in range(width)]


def blocks(text: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """A text in blocks, and up to where words of a block start pointers.

    The next block begins with the last words of the one before, which start no pointer
    there; so a pointer sees all of its ``width`` words, and each word starts one once.
    """
    a, size = 0, CHUNK_BYTES
    while len(text) - a > size:
        inside = _WORD[text[a: a + size]]
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        if len(starts) <= width:  # its words are extremely long
            size *= 2
            continue
        until = int(starts[-width])
        yield text[a: a + size], until
        a, size = a + until, CHUNK_BYTES
    yield text[a:], len(text) - a


def _language(name: str, salt: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt} {name}".encode()).digest()[:8], "little")


def chunks(batches: Iterator[pa.RecordBatch], width: int, salt: int) -> Iterator[tuple[Words, list[str]]]:
    """The words of all texts of a task, a few MB at a time, with the language of each block."""
    held: list[tuple[np.ndarray, int, int]] = []
    names: list[str] = []
    size = 0
    hashes: dict[str, int] = {}
    for batch in batches:
        for text, name in zip(texts_of(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
            if name not in hashes:
                hashes[name] = _language(name, salt)
            for block, until in blocks(text, width):
                held.append((block, until, hashes[name]))
                names.append(name)
                size += len(block)
                if size >= CHUNK_BYTES:
                    yield Words(held, salt), names
                    held, names, size = [], [], 0
    if held:
        yield Words(held, salt), names


def equal_partitions(columns: list[np.ndarray], weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """One pointer and the total weight of each set of equal rows that weighs ``least`` or more.

    Multikey three-way quicksort over pointers, all open partitions at once: each splits at a
    pivot's key into less, equal and greater; the equal part goes on with the next column.
    """
    depths = len(columns)
    keys = np.stack(columns)
    ptr = np.arange(keys.shape[1])
    size, depth = np.array([len(ptr)]), np.zeros(1, dtype=np.int64)
    found, weights = [ptr[:0]], [np.zeros(0, np.int64)]
    while len(ptr):
        begin = np.cumsum(size) - size
        part = np.repeat(np.arange(len(size)), size)
        pivot = keys[depth, ptr[begin + size // 2]]
        key = keys[depth[part], ptr]
        side = (key > pivot[part]) * 2 + (key == pivot[part])
        code = 3 * part + side
        sizes = np.bincount(code, minlength=3 * len(size))
        total = np.bincount(code, weights=weight[ptr], minlength=3 * len(size)).astype(np.int64)
        place = np.cumsum(sizes) - sizes
        moved = np.empty_like(ptr)
        for s in range(3):
            own = sizes[s::3]
            moved[np.repeat(place[s::3] - (np.cumsum(own) - own), own) + np.arange(own.sum())] = ptr[side == s]
        deeper = np.repeat(depth, 3)
        deeper[1::3] += 1
        done = (deeper == depths) & (total >= least) & (sizes > 0)
        found.append(moved[place[done]])
        weights.append(total[done])
        kept = (deeper < depths) & (total >= least) & (sizes > 0)
        ptr = moved[np.repeat(kept, sizes)]
        size, depth = sizes[kept], deeper[kept]
    return np.concatenate(found), np.concatenate(weights)


def entries(columns: list[np.ndarray], shards: int) -> Iterator[tuple[int, int, bytes]]:
    """Equal rows made one with a count, as one blob per shard, ordered by the first column.

    Rows are sorted by a hash that starts with that of the first word, and told apart by all
    columns; an equal row that the sort left elsewhere is an entry of its own.
    """
    lead = fold(columns[:1]) & U(0xFFFFFFFF00000000)
    order = np.argsort(lead | (fold(columns) >> U(32)))
    columns = [c[order] for c in columns]
    new = np.concatenate([[True], reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])])
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(order))
    columns = [c[first] for c in columns]
    shard = (fold(columns) % U(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    bound = np.cumsum(np.bincount(shard, minlength=shards))
    columns, count = [c[order] for c in columns], count[order].astype("<u4")
    a = 0
    for s, b in enumerate(bound.tolist()):
        if b > a:
            planes = count[a:b].view(np.uint8).reshape(-1, 4).T.tobytes()  # mostly zeros after the first
            yield s, b - a, b"".join(c[a:b].astype("<u8").tobytes() for c in columns) + planes
        a = b


def counted(blobs: Iterator[tuple[int, bytes]], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns and counts of blobs (entries, bytes)."""
    parts, counts = [], []
    for n, data in blobs:
        parts.append(np.frombuffer(data, "<u8", width * n).reshape(width, n))
        counts.append(np.frombuffer(data, np.uint8, 4 * n, 8 * width * n).reshape(4, n).T.copy().view("<u4").ravel())
    both = np.concatenate(parts, axis=1)
    return list(both), np.concatenate(counts)


def _word_counts(salt: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(hash, lang, word, n) of the words of a task; the empty word counts all words of a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        held: dict[int, list] = {}
        shared: list[tuple] = []  # words whose hash another word of the task has

        def flush() -> pa.RecordBatch:
            rows = [*((h, *v) for h, v in held.items()), *shared]
            h, lang, word, n = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(h, dtype=U).view(np.int64)), pa.array(lang),
                 pa.array(word, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["h", "lang", "word", "n"])

        for words, names in chunks(batches, 1, salt):
            mine = np.flatnonzero(words.emits)
            for b, n in zip(*np.unique(words.block[mine], return_counts=True), strict=True):
                h = _language(names[b], salt)  # no word has this hash unless the table shows it
                held.setdefault(h, [names[b], b"", 0])[2] += int(n)
            hashes, at, n = np.unique(words.hash[mine], return_index=True, return_counts=True)
            raw = words.data.tobytes()
            at = mine[at]
            for h, k, a, b, i in zip(hashes.tolist(), n.tolist(), words.start[at].tolist(), words.end[at].tolist(),
                                     words.block[at].tolist(), strict=True):
                v = held.get(h)
                if v is None:
                    held[h] = [names[i], raw[a:b], k]
                elif len(v[1]) == b - a and v[1] == raw[a:b] and v[0] == names[i]:
                    v[2] += k
                else:
                    shared.append((h, names[i], raw[a:b], k))
            if len(held) >= FLUSH // 3:
                yield flush()
                held.clear()
                shared.clear()
        if held:
            yield flush()
        release()

    return run


def word_counts(docs: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """(h, lang, word, n) of all words found ``least`` times, and the salt of their hashes.

    The empty word stands for all words of a language.  Sixteen salts are tried for one that
    gives no two words the same hash; at 100 million words the first does but for one in
    4,000 corpora.
    """
    for salt in range(16):
        found = (docs.mapInArrow(_word_counts(salt), "h long, lang string, word string, n long")
                 .repartition("h").groupBy("h")
                 .agg(F.min(F.struct("lang", "word")).alias("one"), F.max(F.struct("lang", "word")).alias("other"),
                      F.sum("n").alias("n")))
        table = scratch(found.where((F.col("n") >= least) | (F.col("one.word") == "") | (F.col("one") != F.col("other"))),
                        f"words-{salt}")
        if table.where(F.col("one") != F.col("other")).isEmpty():
            return table.select("h", "one.lang", "one.word", "n"), salt
    raise RuntimeError("words share hashes under every salt")


def frequent_bits(grams: DataFrame, width: int, count: int) -> np.ndarray:
    """A bit for each hash of a frequent phrase; never over ``MOST_BITS``."""
    bits = SEGMENT_BITS
    while bits < FILTER_BITS * count and bits < MOST_BITS:
        bits *= 2

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = fold([c.to_numpy().view(U) for c in b.columns]) & U(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array((at >> U(20)).astype(np.int32)),
                                              pa.array((at & U(SEGMENT_BITS - 1)).astype(np.int32))], ["part", "bit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            part, bit = b.column("part").to_numpy(), b.column("bit").to_numpy()
            for p in np.unique(part).tolist():
                held.setdefault(p, np.zeros(SEGMENT_BITS, dtype=bool))[bit[part == p]] = True
            if len(held) > 1:  # sorted by part, so only the last one can go on
                done = sorted(held)[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(done, pa.int32()), pa.array(
                    [np.packbits(held.pop(p), bitorder="little").tobytes() for p in done], pa.binary())], ["part", "bits"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(
                [np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())], ["part", "bits"])

    columns = [f"c{k}" for k in range(width)]
    segments = (grams.select(*columns).mapInArrow(index, "part int, bit int").repartition("part")
                .sortWithinPartitions("part").mapInArrow(pack, "part int, bits binary"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in segments.collect():  # bounded by MOST_BITS
        out[r.part * (SEGMENT_BITS // 8): (r.part + 1) * (SEGMENT_BITS // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def _pointers(known: Broadcast, salt: int, width: int, shards: int):
    """Blobs of entries of all phrases of ``width`` words both of whose parts may be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        bits = known.value
        mask = U(len(bits) * 8 - 1)
        held: list[list[np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            if len(columns[0]):
                shard, n, data = zip(*entries(columns, shards), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), pa.array(n, pa.int32()), pa.array(data, pa.binary())],
                    ["shard", "n", "data"])

        for words, _ in chunks(batches, width, salt):
            at = np.flatnonzero(words.starts(width - 1))
            key = fold(words.columns(at, width - 1)) & mask
            may = np.zeros(len(words.hash) + 1, dtype=bool)
            may[at] = (bits[key >> U(3)] >> (key & U(7)).astype(np.uint8)) & 1 == 1
            at = np.flatnonzero(words.starts(width) & words.emits & may[:-1] & may[1:])
            held.append(words.columns(at, width))
            size += len(at)
            if size >= FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
        held.clear()
        release()

    return run


def phrase_counts(docs: DataFrame, salt: int, width: int, known: np.ndarray, shards: int, least: int) -> DataFrame:
    """(c0, c1, ..., n): the word hashes and counts of all phrases found ``least`` times."""
    names = [f"c{k}" for k in range(width)]

    def count(shard: pa.Table) -> pa.Table:
        begin(__name__)
        columns, n = counted(zip(shard.column("n").to_pylist(), shard.column("data").to_pylist(), strict=True), width)
        at, total = equal_partitions(columns, n, least)
        return pa.table([*[pa.array(c[at].view(np.int64)) for c in columns], pa.array(total)], [*names, "n"])

    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(known)
    return (docs.mapInArrow(_pointers(bits, salt, width, shards), "shard int, n int, data binary")
            .groupBy("shard").applyInArrow(count, ", ".join(f"{c} long" for c in [*names, "n"])))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(15,0)")

    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(left) * wide(right))


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, contained_percent: int = 50,
                 top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into
    words ``[^\\x20\\x09]+``.  A candidate is a phrase of 2 to ``max_words`` words of one piece
    found ``a >= least`` times.  Cut after any word it gives l and r, the counts of its two
    parts, and the score floor(1000000 a a / (l r)); the lowest counts, of equals the first.  A
    candidate goes when its words lie inside a longer one found at least
    ``contained_percent`` percent as often.  The order is by score and a, both falling, then by
    phrase (UTF-8 bytes), so ties have an order.  n is the number of all words of the language.

    A null text is empty, a null lang is ``und``; doc_ids are not read, so a repeated row counts
    again; an empty table gives no phrases; other columns may have any names.  A text of any length
    is read whole, in overlapping blocks.  Counts are exact below 10**15.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text IS NOT NULL")
    words, salt = word_counts(docs, least, scratch)
    total = words.where("word = ''").select(F.col("lang").alias("of"), F.col("n").alias("n_words"))
    words = words.where("word <> ''")
    places = total.agg(F.sum("n_words")).first()[0] or 0
    shards = max(4, places // SHARD_ENTRIES) | 1
    tables = {1: words.select(F.col("h").alias("c0"), "n")}
    for width in range(2, max_words + 1):
        known = frequent_bits(tables[width - 1], width - 1, tables[width - 1].count())
        tables[width] = scratch(phrase_counts(docs, salt, width, known, shards, least), f"phrases-{width}")

    def counts_of(phrases: DataFrame, first: int, width: int, name: str) -> DataFrame:
        """``phrases`` with the count of the ``width`` words from word ``first`` on."""
        part = tables[width].select(*[F.col(f"c{k}").alias(f"_{k}") for k in range(width)], F.col("n").alias(name))
        on = [F.col(f"c{first + k}") == F.col(f"_{k}") for k in range(width)]
        return phrases.join(part, on).drop(*[f"_{k}" for k in range(width)])

    found = []
    for width in range(2, max_words + 1):
        names = [f"c{k}" for k in range(width)]
        phrases = tables[width].withColumnRenamed("n", "a")
        for k in range(1, width):
            phrases = counts_of(counts_of(phrases, 0, k, f"l{k}"), k, width - k, f"r{k}")
        cuts = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                         F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, width)]
        phrases = phrases.select(*names, "a", F.array_min(F.array(*cuts)).alias("cut")).select(*names, "a", "cut.*")
        longer = [tables[w].select(*[F.col(f"c{i + k}").alias(f"_{k}") for k in range(width)], "n")
                  for w in range(width + 1, max_words + 1) for i in range(w - width + 1)]
        if longer:
            most = reduce(DataFrame.unionByName, longer).groupBy(*[f"_{k}" for k in range(width)]).agg(
                F.max("n").alias("most"))
            on = [F.col(f"c{k}") == F.col(f"_{k}") for k in range(width)]
            phrases = (phrases.join(most, on, "left")
                       .where(F.col("most").isNull() | (100 * F.col("most") < contained_percent * F.col("a"))))
        found.append(phrases.select(F.array(*names).alias("words"), F.col("c0").alias("lead"), "a", "l", "r", "score"))
    lang = words.select(F.col("h").alias("lead"), "lang")
    found = scratch(reduce(DataFrame.unionByName, found).join(lang, "lead"), "candidates")

    # Where a language's last place may lie, from the histogram of (score, a): no task sees more
    # than ``top`` rows of it, and equal phrases are not sorted by text unless they can count.
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    steps = (found.groupBy("lang", "score", "a").agg(F.count(F.lit(1)).alias("held"))
             .withColumn("step", F.row_number().over(best)).where(F.col("step") <= top)
             .withColumn("before", F.sum("held").over(best.rowsBetween(Window.unboundedPreceding, -1))))
    last = (steps.where(F.coalesce("before", F.lit(0)) < top).groupBy(F.col("lang").alias("of"))
            .agg(F.min(F.struct("score", "a")).alias("last")))
    near = (found.join(last, F.col("lang") == F.col("of")).drop("of")
            .where(F.struct("score", "a") >= F.col("last")).drop("last"))
    for k in range(max_words):
        text = words.select(F.col("h").alias("_h"), F.col("word").alias(f"w{k}"))
        near = near.join(text, F.get("words", F.lit(k)) == F.col("_h"), "left").drop("_h")
    ordered = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (near.withColumn("phrase", F.concat_ws(" ", *[f"w{k}" for k in range(max_words)]))
            .select("lang", "phrase", "a", "l", "r", "score")
            .withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= top)
            .join(total, F.col("lang") == F.col("of"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    F.col("n_words").alias("n"), "score"))
