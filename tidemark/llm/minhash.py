"""Near-duplicate documents by MinHash.

Each document's set of word shingles is reduced to minima of universal hash functions.
Bands of minima bring similar documents together, four bits of each minimum verify the
pair, the full sets confirm it, and the links' connected components are the groups.

Documents with equal sets are one class before any banding, so thousands of exact copies
cost one row.  The members of a band's bucket first meet one *hub* of the bucket and then
four more; a bucket whose members are then in one component is done.  What is left, in the
main the few members of large buckets that nothing links with, is compared across components
in blocks, with the sets at hand: a task gives out links alone, no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

from .components import components
from .local_groups import LocalGroups
from .tokens import U, lower_ascii, mix, powers, texts_of, word_hashes
from .worker import begin

BANDS, ROWS = 24, 5
MINIMA = 128
NIBBLES = 16  # minima in one long of the signature
#: Hubs of a bucket that its members meet first, one round each.
HUBS = (1, 4)
BLOCK = 1024  # members of a bucket that one task compares with as many others


def most_different(percent: int) -> int:
    """Nibbles in which signatures may differ.

    A link at the threshold differs in ``mean`` nibbles, give or take ``deviation``; one in
    about 100,000 such links differs in more than this.
    """
    apart = (100 - percent) / 100 * 15 / 16
    mean, deviation = MINIMA * apart, (MINIMA * apart * (1 - apart)) ** 0.5
    return int(mean + 4.3 * deviation) + 1


SKETCH = ("doc_id long, n_shingles long, set_1 long, set_2 long, signature array<long>, bands array<long>")
SKETCH_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_1", pa.int64()), ("set_2", pa.int64()),
    ("signature", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


def shingles(data: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle."""
    h = word_hashes(lower_ascii(data))
    if not len(h):
        return h
    size = min(words, len(h))
    up, _ = powers(size + 1)
    total = np.zeros(len(h) - size + 1, dtype=U)
    for i in range(size):
        total += mix(h[i: len(h) - size + 1 + i] ^ up[i + 1])
    return np.unique(mix(total + U(size)))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, MINIMA + 1, dtype=U)
    return mix(n) | U(1), mix(n + U(1 << 32))


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set, a few shingles at a time."""
    a, c = _functions()
    out = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=U)
    for i in range(0, len(found), 256):
        out = np.minimum(out, (a[:, None] * found[None, i: i + 256] + c[:, None]).min(axis=1))
    return out


def _signature(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spread = mix(low)
    nibbles = (spread & U(15)).reshape(-1, NIBBLES) << (np.arange(NIBBLES, dtype=U) * U(4))
    parts = spread[: BANDS * ROWS].reshape(BANDS, ROWS)
    band = np.arange(1, BANDS + 1, dtype=U)
    for i in range(ROWS):
        band = mix(band + parts[:, i])
    return np.bitwise_or.reduce(nibbles, axis=1).view(np.int64), band.view(np.int64)


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        for batch in batches:
            rows = []
            for key, data in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                found = shingles(data, words)
                one = two = 0
                signature = bands = np.zeros(0, np.int64)
                if len(found):
                    one, two = (int(mix(found + U(k)).sum().view(np.int64)) for k in (1, 2))
                    signature, bands = _signature(minima(found))
                rows.append((key, len(found), one, two, signature, bands))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SKETCH_ARROW.types, strict=True)],
                schema=SKETCH_ARROW) if rows else pa.RecordBatch.from_pylist([], SKETCH_ARROW)
    return run


def _sets(words: int):
    schema = pa.schema([("node", pa.int64()), ("held", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        for batch in batches:
            held = [shingles(data, words).tobytes() for data in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node").cast(pa.int64()), pa.array(held, pa.binary())],
                                             schema=schema)
    return run


def _confirm(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        for batch in batches:
            good = []
            for x, y in zip(batch.column("held_a"), batch.column("held_b"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), dtype=U) for v in (x, y))
                common = _common(p, q)
                good.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             schema=schema).filter(pa.array(good, pa.bool_()))
    return run


def _different(a: Column, b: Column) -> Column:
    """Nibbles in which two signatures differ."""
    total = F.lit(0)
    for i in range(MINIMA // NIBBLES):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        total = total + F.bit_count(x)
    return total


def _common(p: np.ndarray, q: np.ndarray) -> int:
    """Shared numbers of two sorted sets."""
    if len(p) > len(q):
        p, q = q, p
    return int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(p) else 0


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _settle(percent: int):
    """Links between the components of one pair of blocks of a bucket."""
    most = most_different(percent)
    ones = U(0x1111111111111111)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        a, b = key[1].as_py(), key[2].as_py()
        node, block = table["node"].to_numpy(), table["block"].to_numpy()
        band = table["band"][0].as_py()
        signature = np.array(table["signature"].to_pylist(), np.int64).view(U)
        bands = np.array(table["bands"].to_pylist(), np.int64)
        held = [np.frombuffer(x.as_buffer(), U) for x in table["held"]]
        _, group = np.unique(table["component"].to_numpy(), return_inverse=True)
        groups = LocalGroups(int(group.max()) + 1)
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        found = []
        for i in range(0, len(left), 256):
            for j in range(i if a == b else 0, len(right), 256):
                x, y = left[i: i + 256], right[j: j + 256]
                apart = groups.low[group[x]][:, None] != groups.low[group[y]][None]
                if not apart.any():
                    continue
                bits = signature[x][:, None] ^ signature[y][None]
                bits |= bits >> U(2)
                bits |= bits >> U(1)
                apart &= np.bitwise_count(bits & ones).sum(axis=2) <= most
                # Each pair is looked at in the first bucket that it shares.
                apart &= (bands[x][:, None] == bands[y][None]).argmax(axis=2) == band
                for p, q in zip(*np.nonzero(apart), strict=True):
                    p, q = int(x[p]), int(y[q])
                    if groups.low[group[p]] == groups.low[group[q]]:
                        continue
                    common = _common(held[p], held[q])
                    if 100 * common >= percent * (len(held[p]) + len(held[q]) - common):
                        found.append((node[p], node[q]))
                        groups.join(group[[p]], group[[q]])
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                                    if found else [pa.array([], pa.int64())] * 2, schema=_LINKS)
    return run


def _links(docs: DataFrame, placed: DataFrame, firsts: DataFrame, words: int, percent: int,
           scratch: Scratch) -> DataFrame:
    """Links (a, b) that join everything that any pair of a bucket's members joins.

    placed: (bucket, band, node) of the buckets with several nodes; firsts: (node, signature,
    bands).
    """
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    # Stored, so that Spark knows its bytes and need not shuffle all texts for a short list.
    wanted = scratch(placed.select("node").distinct(), "wanted")
    sets = (docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node", "left_semi")
            .mapInArrow(_sets(words), "node long, held binary")
            .repartition(n, "node").persist(StorageLevel.MEMORY_AND_DISK))
    told = scratch(firsts.join(wanted, "node", "left_semi"), "told")
    links = None
    members = placed.withColumn("component", F.col("node"))
    held = lambda c: sets.select(F.col("node").alias(c), F.col("held").alias(f"held_{c}"))
    side = lambda c: told.select(F.col("node").alias(c), F.col("signature").alias(f"signature_{c}"))
    order = F.struct(F.xxhash64("node", "bucket"), F.col("node"))
    for hubs in HUBS:
        if hubs == 1:
            hub = members.groupBy("bucket").agg(
                F.min(F.struct(order, F.struct("node", "component").alias("hub")))["hub"].alias("hub"))
        else:
            place = F.row_number().over(Window.partitionBy("bucket").orderBy(order))
            hub = (members.withColumn("place", place).where(F.col("place") <= hubs)
                   .select("bucket", F.struct("node", "component").alias("hub")))
        hub = scratch(hub, "hubs")
        met = members.alias("m").join(hub.alias("h"), [
            F.col("m.bucket") == F.col("h.bucket"), F.col("m.component") != F.col("hub.component")])
        pairs = met.select(F.least("m.node", "hub.node").alias("a"),
                           F.greatest("m.node", "hub.node").alias("b")).distinct()
        alike = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .where(_different(F.col("signature_a"), F.col("signature_b")) <= most_different(percent))
                 .select("a", "b"))
        found = scratch(alike.join(held("a"), "a").join(held("b"), "b").select("a", "b", "held_a", "held_b")
                        .mapInArrow(_confirm(percent), "a long, b long").distinct(), "links")
        links = found if links is None else links.unionByName(found)
        groups = scratch(components(links), "groups")
        # The stars join what the links joined, and the next components end in fewer rounds.
        links = groups.where("component < node").select(F.col("component").alias("a"), F.col("node").alias("b"))
        used = hub.select("bucket", F.col("hub.node").alias("node"))
        left = scratch(members.drop("component").join(used, ["bucket", "node"], "left_anti")
                       .join(groups, "node", "left")
                       .select("bucket", "band", "node", F.coalesce("component", "node").alias("component")), "left")
        mixed = scratch(left.groupBy("bucket").agg(
            F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"))
            .where("x < y").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "mixed")
        members = scratch(left.join(mixed, "bucket", "left_semi"), "members")
        if members.isEmpty():
            break
    else:
        dealt = (members.join(mixed, "bucket")
                 .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))
                 .drop("blocks", "other"))
        late = (dealt.join(told, "node").join(sets, "node").groupBy("bucket", "a", "b")
                .applyInArrow(_settle(percent), "a long, b long"))
        links = links.unionByName(scratch(late.distinct(), "late"))
    sets.unpersist()
    return links


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Documents are linked if 100 * common shingles >= ``percent`` * all shingles of both,
    shingles being ``words`` consecutive words, A-Z in lower case.  ``component_id`` is the
    smallest doc_id that links lead to, the document's own included; ``kept`` marks it.  A
    text with fewer words is one shingle; a null or blank text has none and links with
    nothing.  A null doc_id links with nothing and is kept, with a null component.  Rows that
    repeat a doc_id are one document with several texts.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = scratch(base.mapInArrow(_sketch(words), SKETCH), "sketch")
    usable = sketch.where("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "set_1", "set_2"]
    classes = scratch(usable.groupBy(*key).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                      .where("n > 1").drop("n"), "classes")
    joined = usable.join(classes, key, "left")
    copies = joined.where("first < doc_id").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    copies = scratch(copies.distinct(), "copies")
    # Rows of one doc_id with the same set count once; other documents' copies are left out.
    firsts = scratch(joined.where("first is null or first = doc_id")
                     .select(F.col("doc_id").alias("node"), "signature", "bands"), "firsts")
    banded = firsts.select("node", F.posexplode("bands").alias("band", "bucket"))
    several = scratch(banded.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y"))
                      .where("x < y").select("bucket"), "buckets")
    placed = scratch(banded.join(several, "bucket", "left_semi"), "placed")
    links = copies
    if not placed.isEmpty():
        links = links.unionByName(_links(base, placed, firsts, words, percent, scratch))
    groups = components(links).withColumnRenamed("node", "doc_id")
    return (sketch.select("doc_id", "n_shingles").join(groups, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
