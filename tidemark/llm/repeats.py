"""Windows of tokens that also start in an earlier document, for any kind of token.

Shared by the substring operators.  Each window of ``window`` tokens is tied to one of its
grams of ``gram`` tokens: the one with the least hash.  So each text is cut into *phrases*,
the windows tied to one gram occurrence, whatever the text around; equal windows sit at the
same place of phrases with the same gram.  Three shuffles find the spans to remove:

1. Phrases as (gram hash, phrase hash, place), packed into one blob per batch and shard of
   gram hashes.  Phrases equal to one of a smaller doc_id in the same batch are settled in
   the map task, so a phrase that a third of all texts hold arrives once per batch.
2. A shard settles phrases equal to one of a smaller doc_id (all 64 bits of both hashes: the
   gram is the same for all phrases compared, so the phrase hash alone must tell them apart).
   Of each set of equal phrases the first stays open if its gram also has other phrases.
3. Only the tokens of open phrases are fetched, by text shard, and sent to the gram's
   shard, where ``settle`` compares token for token.  A gram with more than ``most_open``
   open phrases, such as the edge of a passage that very many texts hold, would be one task's
   work; its windows go by their own hash (128 bits) instead, so they spread over all shards,
   and a window that many texts hold arrives once per text shard.

The texts are shuffled once; both passes over them read the same exchange.
Rows are told apart by (doc_id, hash of the text), so a repeated row gets the same spans.
A null doc_id has no order: its row stays whole and removes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import U, mix, prefix_sums, spans_hash, texts_of
from .worker import begin, release

SHARD_BYTES = 8 << 20
FLUSH = 1_000_000  # phrases held by a map task before they are packed, 30 bytes each
BATCH_BYTES = 8 << 20

# A phrase has at most window - gram + 1 windows; WIDEST keeps their count within two bytes.
PLACE = np.dtype([("row", "<u4"), ("start", "<u4"), ("count", "<u2")])
ASKED = np.dtype([("gram", "<u8"), ("phrase", "<u8"), ("row", "<u4"), ("start", "<u4"), ("count", "<u2")])
OPEN = np.dtype([("gram", "<u8"), ("row", "<u4"), ("start", "<u4"), ("count", "<u2")])
WIDEST = 65_535
WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("row", "<u4"), ("start", "<u4")])
PACKED = "shard int, kind int, ids binary, marks binary, data binary"

#: Tokens of a text as hashes, one per token, and as what ``settle`` compares.
Tokens = Callable[[np.ndarray], np.ndarray]
#: (tokens of all open phrases, their offsets, row of each) -> for each window (phrase by
#: phrase) whether it also starts in a row with a smaller doc_id.
Settle = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Plan:
    window: int
    gram: int
    hashes: Tokens
    values: Tokens
    kind: str  # numpy type of the values
    settle: Settle
    #: Open phrases of one gram that ``settle`` may get.
    most_open: int
    #: (bytes of a text, removed span starts, ends) -> tokens, tokens removed, what is left.
    rest: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[int, int, bytes]]


def shards(spark: SparkSession, docs: DataFrame) -> int:
    """Shards of a few MB of text each, by Spark's estimate of the input's size."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # Spark has no estimate for rows that Python made, and says 2**63.
    if size >= 1 << 58:
        return 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) | 1
    return max(4, size // SHARD_BYTES) | 1


def phrases(tokens: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Gram hash, phrase hash, first window start and window count of each phrase of a text."""
    n = len(tokens)
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(U), none.astype(U), none, none
    sums = prefix_sums(tokens)
    at = np.arange(n - gram + 1)
    grams = spans_hash(sums, at, at + gram)
    key = (grams & U(0xFFFFFFFF00000000)) | at.astype(U)  # the earlier place settles a tie
    wide, size = window - gram + 1, 1
    least = key
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = n - window + 1
    least = np.minimum(least[:count], least[wide - size: wide - size + count])
    tied = (least & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], tied[1:] != tied[:-1]]))
    after = np.append(first[1:], count)
    return grams[tied[first]], spans_hash(sums, first, after + window - 1), first, after - first


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of one text, sorted and joined where they touch."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def _rows(parts: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows, each of some ``BATCH_BYTES``."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    held, size = [], 0
    for row in parts:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


PACKED_ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()),
                          ("marks", pa.binary()), ("data", pa.binary())])


def _planes(data: np.ndarray) -> bytes:
    """Entries byte by byte: first bytes first, so that the bytes that are always zero compress."""
    return np.ascontiguousarray(data.view(np.uint8).reshape(len(data), -1).T).tobytes()


def _entries(planes: bytes | memoryview, dtype: np.dtype) -> np.ndarray:
    whole = np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, -1)
    return np.array(whole.T, order="C").view(dtype).ravel()


def _deal(of: np.ndarray, kind: int, ids: np.ndarray, marks: np.ndarray, data: np.ndarray) -> Iterator[tuple]:
    """One packed row per shard; each names only the texts that its entries use."""
    order = np.argsort(of, kind="stable")
    edges = np.flatnonzero(np.diff(of[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = data[order[a:b]]
        used, part["row"] = np.unique(part["row"], return_inverse=True)
        yield (int(of[order[a]]), kind, ids[used].tobytes(), marks[used].tobytes(), _planes(part))


def _unpack(table: pa.Table, kind: int, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a kind, their rows renumbered over one list of texts sorted by doc_id."""
    ids, marks, data, base = [], [], [], 0
    for k, i, m, d in zip(table["kind"].to_pylist(), table["ids"], table["marks"], table["data"], strict=True):
        if k == kind:
            ids.append(np.frombuffer(i.as_buffer(), dtype=np.int64))
            marks.append(np.frombuffer(m.as_buffer(), dtype=np.int32))
            data.append(_entries(d.as_buffer(), dtype))
            data[-1]["row"] += base
            base += len(ids[-1])
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, dtype)
    ids, marks, data = np.concatenate(ids), np.concatenate(marks), np.concatenate(data)
    order = np.lexsort((marks, ids))
    new = np.concatenate([[True], (np.diff(ids[order]) != 0) | (np.diff(marks[order]) != 0)])
    place = np.empty(len(ids), np.int64)
    place[order] = np.cumsum(new) - 1
    data["row"] = place[data["row"]]
    return ids[order][new], marks[order][new], data


# A text's shard is a linear hash of its id and mark, the same here and in Spark.
_PRIME, _BY_ID, _BY_MARK = (1 << 31) - 1, 1_103_515_245, 1_812_433_253


def _text_shard(ids: np.ndarray, marks: np.ndarray, n: int) -> np.ndarray:
    spread = (ids % _PRIME) * _BY_ID + (marks.astype(np.int64) % _PRIME) * _BY_MARK
    return (spread % _PRIME % n).astype(np.int32)


def _text_shard_column(n: int) -> Column:
    key, mark = F.coalesce(F.col("doc_id"), F.col("mark").cast("long")), F.col("mark").cast("long")
    spread = F.pmod(key, F.lit(_PRIME)) * _BY_ID + F.pmod(mark, F.lit(_PRIME)) * _BY_MARK
    return F.pmod(F.pmod(spread, F.lit(_PRIME)), F.lit(n)).cast("int")


def _equal_runs(*keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys that each sorted place belongs to."""
    new = np.zeros(len(keys[0]), dtype=bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _ask(plan: Plan, n: int, texts: int = 0) -> Callable:
    """Step 1 for the batches of a task, for n shards of grams and so many (n) of texts."""
    texts = texts or n

    def flush(held: list, ids: list, marks: list) -> Iterator[pa.RecordBatch]:
        ids, marks = np.array(ids, np.int64), np.array(marks, np.int32)
        if not held:
            return
        by_id = np.lexsort((marks, ids))
        rank = np.empty(len(ids), np.uint32)
        rank[by_id] = np.arange(len(ids))
        ids, marks = ids[by_id], marks[by_id]
        asked = np.empty(sum(len(h[1]) for h in held), ASKED)
        asked["row"] = np.repeat(rank[[h[0] for h in held]], [len(h[1]) for h in held])
        for c, name in enumerate(("gram", "phrase", "start", "count"), 1):
            np.concatenate([h[c] for h in held], out=asked[name], casting="unsafe")
        held.clear()
        asked = asked[np.lexsort((asked["row"], asked["gram"] ^ (asked["phrase"] * U(0x9E3779B97F4A7C15))))]
        run = _equal_runs(asked["gram"], asked["phrase"])
        first = ids[asked["row"][np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))]][run]
        later = ids[asked["row"]] > first
        del run, first
        known = np.zeros(int(later.sum()), PLACE)
        for c in PLACE.names:
            known[c] = asked[c][later]
        asked = asked[~later]
        yield from _rows(_deal((asked["gram"] % U(n)).astype(np.int32), 0, ids, marks, asked), PACKED_ARROW)
        if len(known):
            # Dealt by text, and passed on unread by the shards of grams.
            of = _text_shard(ids, marks, texts)[known["row"]]
            yield from _rows(_deal(of, 1, ids, marks, known), PACKED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        held, ids, marks, size = [], [], [], 0
        for batch in batches:
            for key, mark, data in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(),
                                       texts_of(batch.column("text")), strict=True):
                found = phrases(plan.hashes(data), plan.window, plan.gram)
                if len(found[0]) and key is not None:
                    held.append((len(ids), *found[:2], found[2].astype("<u4"), found[3].astype("<u2")))
                    ids.append(key)
                    marks.append(mark)
                    size += len(found[0])
                if size >= FLUSH:
                    yield from flush(held, ids, marks)
                    held, ids, marks, size = [], [], [], 0
        yield from flush(held, ids, marks)
        release()

    return run


def _compare(plan: Plan, texts: int) -> Callable:
    """Step 2 for one shard of grams: (kind 1) settled places, (kind 2) open phrases, (kind 3)
    open phrases of grams that have more than ``most_open``."""
    def run(table: pa.Table) -> pa.Table:
        begin(__name__)
        out = []
        for k, s, i, m, d in zip(table["kind"].to_pylist(), table["shard"].to_pylist(), table["ids"],
                                 table["marks"], table["data"], strict=True):
            if k == 1:
                out.append((s, 1, i.as_py(), m.as_py(), d.as_py()))
        ids, marks, asked = _unpack(table, 0, ASKED)
        if len(asked):
            asked = asked[np.lexsort((asked["row"], asked["phrase"], asked["gram"]))]
            by_gram = _equal_runs(asked["gram"])
            by_phrase = _equal_runs(asked["gram"], asked["phrase"])
            first = np.flatnonzero(np.concatenate([[True], np.diff(by_phrase) != 0]))
            least = ids[asked["row"]][first][by_phrase]
            settled = ids[asked["row"]] > least
            kinds = np.bincount(by_gram[first])[by_gram]
            many = ~settled & (kinds > 1)
            # Phrases that all come from one document cannot remove anything.
            start = np.flatnonzero(np.concatenate([[True], np.diff(by_gram) != 0]))
            low = np.minimum.reduceat(ids[asked["row"]], start)[by_gram]
            high = np.maximum.reduceat(ids[asked["row"]], start)[by_gram]
            many &= low < high
            of = _text_shard(ids, marks, texts)
            known = np.zeros(int(settled.sum()), PLACE)
            for c in ("row", "start", "count"):
                known[c] = asked[c][settled]
            out += _deal(of[known["row"]], 1, ids, marks, known)
            crowd = np.bincount(by_gram, weights=many)[by_gram] > plan.most_open
            for kind, held in ((2, many & ~crowd), (3, many & crowd)):
                opened = np.zeros(int(held.sum()), OPEN)
                for c in OPEN.names:
                    opened[c] = asked[c][held]
                out += _deal(of[opened["row"]], kind, ids, marks, opened)
        return pa.Table.from_batches(list(_rows(out, PACKED_ARROW)), PACKED_ARROW)

    return run


def _texts(table: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    return {(i, m): t for i, m, t in zip(table["doc_id"].to_pylist(), table["mark"].to_pylist(),
                                         texts_of(table["text"]), strict=True)}


def _first_windows(ids: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted by hash, and whether each also starts in a row with a smaller doc_id."""
    found = found[np.lexsort((ids[found["row"]], found["two"], found["one"]))]
    run = _equal_runs(found["one"], found["two"])
    first = np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))
    return found, ids[found["row"]] > ids[found["row"]][first][run]


def _later(found: np.ndarray) -> np.ndarray:
    known = np.zeros(len(found), PLACE)
    known["row"], known["start"], known["count"] = found["row"], found["start"], 1
    return known


def _windows(plan: Plan, n: int, of_texts: int, held: dict[tuple[int, int], np.ndarray], places: pa.Table) -> Iterator[tuple]:
    """(kind 3) The first copy in this shard of texts of each window of crowded grams; later
    ones are settled (kind 1) at once."""
    ids, marks, asked = _unpack(places, 3, OPEN)
    if not len(asked):
        return
    asked = asked[np.argsort(asked["row"], kind="stable")]
    edges = np.flatnonzero(np.diff(asked["row"].astype(np.int64), prepend=-1, append=-1))
    parts = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        row, count = int(asked["row"][a]), asked["count"][a:b].astype(np.int64)
        start = np.arange(count.sum()) + np.repeat(asked["start"][a:b] - np.cumsum(count) + count, count)
        tokens = plan.hashes(held[(int(ids[row]), int(marks[row]))])
        part = np.zeros(len(start), WINDOW)
        part["row"], part["start"] = row, start
        for c, x in (("one", tokens), ("two", mix(tokens + U(1)))):
            part[c] = spans_hash(prefix_sums(x), start, start + plan.window)
        parts.append(part)
    found, later = _first_windows(ids, np.concatenate(parts))
    known, found = _later(found[later]), found[~later]
    if len(known):
        yield from _deal(_text_shard(ids, marks, of_texts)[known["row"]], 1, ids, marks, known)
    yield from _deal((found["one"] % U(n)).astype(np.int32), 3, ids, marks, found)


def _fetch(plan: Plan, n: int, of_texts: int) -> Callable:
    """Step 3a for one shard of texts: the tokens of its open phrases, by shard of grams, and
    the windows of the phrases of crowded grams, by shard of window hashes."""
    def run(texts: pa.Table, places: pa.Table) -> pa.Table:
        begin(__name__)
        held = _texts(texts)
        out = list(_windows(plan, n, of_texts, held, places))
        ids, marks, asked = _unpack(places, 2, OPEN)
        if len(asked):
            asked = asked[np.argsort(asked["row"], kind="stable")]
            values, last = None, -1
            parts: dict[int, list[tuple]] = {}
            for k, (gram, row, start, count) in enumerate(asked.tolist()):
                if row != last:
                    values, last = plan.values(held[(int(ids[row]), int(marks[row]))]), row
                parts.setdefault(gram % n, []).append((k, values[start: start + count + plan.window - 1]))
            for shard, found in parts.items():
                part = asked[[k for k, _ in found]]
                used, part["row"] = np.unique(part["row"], return_inverse=True)
                data = (np.int64(len(part)).tobytes() + _planes(part)
                        + np.concatenate([v for _, v in found]).tobytes())
                out.append((shard, 2, ids[used].tobytes(), marks[used].tobytes(), data))
        return pa.Table.from_batches(list(_rows(out, PACKED_ARROW)), PACKED_ARROW)

    return run


def _settle(plan: Plan, texts: int) -> Callable:
    """Step 3b for one shard of grams and of window hashes: windows of open phrases that start
    in an earlier text."""
    def run(table: pa.Table) -> pa.Table:
        begin(__name__)
        out = []
        for k, s, i, m, d in zip(table["kind"].to_pylist(), table["shard"].to_pylist(), table["ids"],
                                 table["marks"], table["data"], strict=True):
            if k == 1:
                out.append((s, 1, i.as_py(), m.as_py(), d.as_py()))
        ids, marks, found = _unpack(table, 3, WINDOW)
        if len(found):
            found, later = _first_windows(ids, found)
            known = _later(found[later])
            out += _deal(_text_shard(ids, marks, texts)[known["row"]], 1, ids, marks, known)
        out += compared(table.filter(pc.equal(table["kind"], 2)))
        return pa.Table.from_batches(list(_rows(out, PACKED_ARROW)), PACKED_ARROW)

    def compared(table: pa.Table) -> Iterable[tuple]:
        if not len(table):
            return []
        ids, marks, heads, values, base = [], [], [], [], 0
        for i, m, d in zip(table["ids"], table["marks"], table["data"], strict=True):
            raw = d.as_py()
            after = 8 + int(np.frombuffer(raw, np.int64, 1)[0]) * OPEN.itemsize
            head = _entries(raw[8: after], OPEN)
            head["row"] += base
            ids.append(np.frombuffer(i.as_py(), np.int64))
            marks.append(np.frombuffer(m.as_py(), np.int32))
            base += len(ids[-1])
            heads.append(head)
            values.append(np.frombuffer(raw, plan.kind, offset=after))
        ids, marks = np.concatenate(ids), np.concatenate(marks)
        heads, values = np.concatenate(heads), np.concatenate(values)
        size = heads["count"].astype(np.int64) + plan.window - 1
        at = np.concatenate([[0], np.cumsum(size)])
        hit = plan.settle(values, at, ids[heads["row"]], heads["gram"])
        counts = heads["count"].astype(np.int64)
        of = np.repeat(np.arange(len(heads)), counts)
        inner = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        found = np.zeros(int(hit.sum()), PLACE)
        found["row"] = heads["row"][of[hit]]
        found["start"] = (heads["start"][of] + inner)[hit]
        found["count"] = 1
        return _deal(_text_shard(ids, marks, texts)[found["row"]], 1, ids, marks, found) if len(found) else []

    return run


KEPT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
KEPT = "doc_id long, n_tokens long, n_removed long, kept binary, starts array<long>, ends array<long>"


def remove_repeats(docs: DataFrame, plan: Plan, carry: tuple[str, ...] = (), within: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): what is left of it and the spans removed.

    ``kept`` holds what ``plan.rest`` makes of the tokens left; ``starts`` and ``ends`` are the
    removed spans in tokens, sorted and joined.  They cover exactly the windows that also
    start in a row with a smaller doc_id.  Columns named in ``carry`` are passed through: as they are,
    or in a struct named ``within``, when they may also have names of the result's columns.  All
    others are not read.  A null text is an empty one; a row with a null doc_id stays whole.
    """
    clash = {c.split()[0] for c in KEPT.split(", ")}.intersection([within] if within else carry)
    if clash:
        raise ValueError(f"carried columns have names of the result's: {sorted(clash)}")
    if not plan.gram <= plan.window <= WIDEST:
        raise ValueError(f"windows of {plan.gram} to {WIDEST} tokens are supported, not {plan.window}")
    spark = docs.sparkSession
    n = shards(spark, docs)
    texts = 4 * n | 1  # smaller ones: their tasks hold whole texts
    carried = [f"carried_{i}" for i in range(len(carry))]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       *[docs[f"`{c}`"].alias(a) for c, a in zip(carry, carried, strict=True)])
    base = base.withColumn("mark", F.hash("text"))
    places = (base.select("doc_id", "mark", "text").mapInArrow(_ask(plan, n, texts), PACKED)
              .groupBy("shard").applyInArrow(_compare(plan, texts), PACKED))
    by_shard = base.withColumn("shard", _text_shard_column(texts)).groupBy("shard")
    late = (by_shard.cogroup(places.where("kind > 1").groupBy("shard"))
            .applyInArrow(_fetch(plan, n, texts), PACKED)
            .groupBy("shard").applyInArrow(_settle(plan, texts), PACKED))
    known = places.where("kind = 1").unionByName(late)

    def finish(texts: pa.Table, table: pa.Table) -> pa.Table:
        begin(__name__)
        ids, marks, found = _unpack(table, 1, PLACE)
        found = found[np.argsort(found["row"], kind="stable")]
        at = np.searchsorted(found["row"], np.arange(len(ids) + 1))
        place = {k: i for i, k in enumerate(zip(ids.tolist(), marks.tolist(), strict=True))}
        rows = []
        for key, mark, data in zip(texts["doc_id"].to_pylist(), texts["mark"].to_pylist(),
                                   texts_of(texts["text"]), strict=True):
            r = place.get((key, mark))
            part = found[at[r]: at[r + 1]] if r is not None else found[:0]
            start = part["start"].astype(np.int64)
            start, end = merged(start, start + part["count"] + plan.window - 1)
            rows.append((key, *plan.rest(data, start, end), start.tolist(), end.tolist()))
        out = pa.Table.from_batches(list(_rows(rows, KEPT_ARROW)), KEPT_ARROW)
        for a in carried:
            out = out.append_column(a, texts[a])
        return out

    kinds = "".join(f", {a} {base.schema[a].dataType.simpleString()}" for a in carried)
    out = by_shard.cogroup(known.groupBy("shard")).applyInArrow(finish, KEPT + kinds)
    passed = [F.col(a).alias(c) for c, a in zip(carry, carried, strict=True)]
    return out.select(*KEPT_ARROW.names, *([F.struct(*passed).alias(within)] if carry and within else passed))
