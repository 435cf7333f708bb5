"""Near-duplicate embeddings by a pivot-permutation index.

Each vector is described by its nearest pivots in order.  Inverted lists hold the vectors
that have a pivot among their nearest; two vectors of a list are candidates if they share
enough pivots, and are verified by their cosine in double precision.  Long lists are cut
into blocks, and pairs of blocks are spread over tasks.  Neither candidates nor links leave
a task: only each vector's number of links, and one edge per vector for the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

from .components import components
from .local_groups import LocalGroups
from .tokens import U, mix

COSINE = 0.93
#: Nearest pivots kept of each vector, and how many of them candidates share.
NEAREST, SHARED = 8, 3
#: Pivots: twice the square root of the number of vectors, within these bounds.
FEWEST_PIVOTS, MOST_PIVOTS = 64, 4096
#: Vectors drawn for each pivot wanted, and the cosines from which a pivot is too near another:
#: the least that leaves half of the pivots wanted, else the last.
DRAWN, TOO_NEAR = 3, (0.7, 0.8, 0.9)
BLOCK = 2048  # vectors of a list that one task compares with as many others

VECTORS = "vec_id long, label string, held binary, one long, two long"
_VECTORS = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("held", pa.binary()),
                      ("one", pa.int64()), ("two", pa.int64())])
LISTED = "label string, pivot int, node long, copies long, held binary, nearest binary"
_LISTED = pa.schema([("label", pa.string()), ("pivot", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()),
                     ("held", pa.binary()), ("nearest", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)],
                                      schema=schema)


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length 1 as bytes, with two hashes of what they were."""
    for batch in batches:
        rows = []
        for key, label, value in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(),
                                     batch.column("embedding"), strict=True):
            if not value.is_valid or value.values.null_count or not len(value.values):
                continue
            v = value.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zero
            # Scaling first keeps squares of very large and very small numbers in range.
            top = np.abs(v).max()
            if not np.isfinite(top) or top == 0:
                continue
            unit = v / top
            unit = unit / np.sqrt((unit * unit).sum())
            place = np.arange(1, len(v) + 1, dtype=U)
            one, two = (int(mix(v.view(U) ^ mix(place + U(k << 32))).sum().view(np.int64)) for k in (1, 2))
            rows.append((key, label, unit.tobytes(), one, two))
        yield _batch(rows, _VECTORS)


def _describe(pivots: dict[int, np.ndarray]):
    """A row for each of the nearest pivots of each vector; -1 where its length has no pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, node, copies, held in zip(*(batch.column(c).to_pylist() for c in (
                    "label", "node", "copies", "held")), strict=True):
                v = np.frombuffer(held)
                at = pivots.get(len(v))
                near = np.array([-1], np.int32)
                if at is not None:
                    near = np.argsort(-(at @ v), kind="stable")[:NEAREST].astype(np.int32)
                rows += [(label, p, node, copies, held, near.tobytes()) for p in near.tolist()]
            yield _batch(rows, _LISTED)
    return run


_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])


def _verify(cosine: float):
    """Links of one pair of blocks of a list: each pair of vectors counts in the list of the
    least pivot that they share."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        pivot, a, b = key[1].as_py(), key[2].as_py(), key[3].as_py()
        node = table["node"].to_numpy()
        order = np.argsort(node, kind="stable")
        node, copies, block = node[order], table["copies"].to_numpy()[order], table["block"].to_numpy()[order]
        held = [np.frombuffer(x.as_buffer()) for x in table["held"]]
        held, near = [held[i] for i in order], [table["nearest"][i].as_py() for i in order.tolist()]
        sizes = np.array([len(v) for v in held])
        links, groups = np.zeros(len(node), np.int64), LocalGroups(len(node))
        for size in np.unique(sizes):  # vectors of different lengths have no cosine
            for rows, others in _tiles(np.flatnonzero(sizes == size), block, a, b):
                x, y = np.stack([held[i] for i in rows]), np.stack([held[i] for i in others])
                p, q = (np.stack([np.frombuffer(near[i], np.int32) for i in r]) for r in (rows, others))
                shared = np.zeros((len(rows), len(others)), np.int16)
                least = np.full(shared.shape, np.iinfo(np.int32).max, np.int32)
                for c in range(p.shape[1]):
                    same = (p[:, c, None, None] == q[None]).any(axis=2)
                    shared += same
                    np.minimum(least, p[:, c, None], out=least, where=same)
                fits = (shared >= min(SHARED, p.shape[1])) & (least == pivot) & (rows[:, None] < others[None])
                if a != b:
                    fits |= (shared >= min(SHARED, p.shape[1])) & (least == pivot) & (rows[:, None] > others[None])
                i, j = np.nonzero(fits & (x @ y.T >= cosine))
                i, j = rows[i], others[j]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                groups.join(i, j)
        hit = np.flatnonzero(links > 0)
        return pa.table([node[hit], links[hit], node[groups.low[hit]]], schema=_FOUND)
    return run


def _tiles(at: np.ndarray, block: np.ndarray, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Small tiles of the pairs between block ``a`` and block ``b``."""
    left, right = at[block[at] == a], at[block[at] == b]
    for i in range(0, len(left), 256):
        for j in range(i if a == b else 0, len(right), 256):
            yield left[i: i + 256], right[j: j + 256]


def _apart(drawn: np.ndarray, wanted: int) -> np.ndarray:
    """Vectors of ``drawn``, in order, that are not too near one taken before.

    Drawn in proportion to the data, pivots would crowd in a large group of near copies, and
    noise would decide which of them are nearest to its members.
    """
    for limit in TOO_NEAR:
        taken, n = np.empty((min(wanted, len(drawn)), drawn.shape[1])), 0
        for v in drawn:
            if n < len(taken) and (taken[:n] @ v < limit).all():
                taken[n] = v
                n += 1
        if 2 * n >= len(taken):
            break
    return taken[:n]


def _pivots(nodes: DataFrame, total: int) -> dict[int, np.ndarray]:
    """A bounded sample of vectors: those with least hash of their id that lie apart."""
    wanted = min(MOST_PIVOTS, max(FEWEST_PIVOTS, int(2 * total ** 0.5)))
    by_size: dict[int, list[np.ndarray]] = {}
    for r in nodes.orderBy(F.xxhash64("node"), "node").limit(DRAWN * wanted).select("held").collect():
        v = np.frombuffer(bytes(r.held))
        by_size.setdefault(len(v), []).append(v)
    return {n: _apart(np.stack(v), wanted) for n, v in by_size.items()}


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked if their labels are equal and not null, they have as many numbers,
    their cosine is at least ``cosine`` and the index finds the pair (tests hold its recall
    against brute force).  Equal vectors are one class, so copies need no pairs.  ``n_links``
    counts other vectors linked directly; ``component_id`` is the smallest vec_id that links
    lead to, itself included, and ``kept`` marks it.  Null, zero and empty vectors and those
    with null or non-finite numbers link with nothing, as do rows without vec_id.  Rows that
    repeat a vec_id and its vector count once.  An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    usable = scratch(base.where("vec_id is not null and label is not null and embedding is not null")
                     .mapInArrow(_usable, VECTORS), "usable")
    key = ["label", "one", "two"]
    copies = usable.select(*key, "vec_id").distinct().groupBy(*key).agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    copies = scratch(copies, "classes")
    members = usable.select(*key, "vec_id").distinct().join(copies, key).select("vec_id", "node", "copies")
    members = scratch(members, "members")
    first = usable.join(copies.withColumnRenamed("node", "vec_id"), [*key, "vec_id"]).dropDuplicates(["vec_id", *key])
    nodes = scratch(first.select("label", F.col("vec_id").alias("node"), "copies", "held"), "nodes")
    pivots = _pivots(nodes, copies.count())
    listed = scratch(nodes.mapInArrow(_describe(pivots), LISTED), "listed")
    lists = listed.groupBy("label", "pivot").agg(F.count("*").alias("n")).where("n > 1").select(
        "label", "pivot", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (listed.join(scratch(lists, "lists"), ["label", "pivot"]).withColumn("block", block)
             .withColumn("other", other)
             .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))
             .drop("blocks", "other"))
    found = scratch(dealt.groupBy("label", "pivot", "a", "b").applyInArrow(
        _verify(cosine), "node long, links long, to long"), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    same = members.where("node < vec_id").select(F.col("node").alias("a"), F.col("vec_id").alias("b"))
    near = found.select(F.col("to").alias("a"), F.col("node").alias("b"))
    groups = components(near.unionByName(same)).withColumnRenamed("node", "vec_id")
    counted = members.join(links, "node", "left").groupBy("vec_id").agg(
        F.max(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return (base.select("vec_id").join(scratch(counted, "counted"), "vec_id", "left").join(groups, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
