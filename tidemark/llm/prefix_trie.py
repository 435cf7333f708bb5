"""The trie of shared conversation prefixes, from sorted sequences of turns.

Sequences are sorted by their turns all over the cluster, so the members of a node are
neighbours.  Inside a block of sorted sequences, union-find joins neighbours in descending
order of their longest common prefix: where components meet at a depth, a branching node
comes to be there, and the nodes between it and a component's own depth form a chain that
has the component's members.  A block is thus contracted to its branching nodes.

Every count of a node is a sum over its members, each of which looks at its left neighbour
alone.  So blocks are merged across their boundaries by adding: only prefixes of a block's
first and last sequence can reach into another block.  These go out as partial rows under a
digest of the prefix, are corrected for the common prefix of the two sequences that meet at a
boundary, and are summed.  No task holds more than a block, whatever the size of a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.store import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn's key, and of a node's digest.
KEY = 16
#: A block ends after so many sequences, or turns.
BLOCK_SEQUENCES = 1 << 16
BLOCK_TURNS = 1 << 20
#: Bytes of sort keys that finding the ranges may gather from its sample (100 a partition).
SAMPLE_BYTES = 64 << 20

NODE, OPEN, EDGE, ENDS = range(4)
_PIECES = ("kind int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
           "n_children long, n_leaves long, saved_tokens long, ends string, block long, first_key binary, "
           "first_words binary, last_key binary")
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]
_TYPES = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.large_string()}[c.split()[1]]
          for c in _PIECES.split(", ")]
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) for each conv_id; turns are structs (turn, key, words) in order.

    ``key`` stands for (role, text) and ``words`` counts the words of the text.  Null turns
    come first, a null role or text is an empty one, rows of equal turn are put in the order
    of their keys, a repeated row counts as often as it is there.  Rows without a conv_id
    belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    one = F.struct("turn", F.substring(F.sha2(whole, 256), 1, 2 * KEY).alias("key"),
                   F.regexp_count(text, F.lit(WORD)).alias("words"))
    return (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("turn"))
            .withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
            .repartition("base").groupBy("base", "conv_id")
            .agg(F.sort_array(F.collect_list("turn")).alias("turns")))


def with_shared_heads(sequences: DataFrame, heads: Column) -> DataFrame:
    """(conv_id, turns) where the first ``heads`` turns are those of the conversation named in
    ``base``: all of it if it is shorter, none if there is none.

    The conversations of a base are in one place already (see :func:`turn_sequences`), so this
    shuffles nothing; each base has 20 of them.
    """
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 3))).over(Window.partitionBy("base"))
    return (sequences.withColumn("head", head).withColumn("h", heads)
            .select("conv_id", F.concat(
                F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", 1, F.col("h"))),
                F.expr("slice(turns, h + 1, size(turns))")).alias("turns")))


def common_turns(a: bytes, b: bytes) -> int:
    """The turns that two keys share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    low, high = 0, n
    while high - low > 1:  # a[:low] == b[:low], a[:high] != b[:high]
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low // KEY


def digests(key: bytes, upto: int) -> list[bytes]:
    """Digests of the prefixes of 0..upto turns, each made from the one before."""
    out = [b"\x00" * KEY]
    for d in range(upto):
        out.append(hashlib.blake2b(out[-1] + key[d * KEY:(d + 1) * KEY], digest_size=KEY).digest())
    return out


class Forest:
    """The contracted trie of one block of sorted sequences.

    Places 0..m-1 are the sequences, later ones branching nodes.  ``top`` is the depth of a
    place, ``saved`` the sum over its members but the first of the words of the turns that a
    member shares with its left neighbour.
    """

    def __init__(self, keys: list[bytes], conv_ids: list[int], words: list[np.ndarray]):
        m = len(keys)
        self.keys, self.conv_ids = keys, conv_ids
        self.length = [len(k) // KEY for k in keys]
        self.upto = [np.concatenate([[0], np.cumsum(w, dtype=np.int64)]) for w in words]
        self.common = [0] + [common_turns(keys[i - 1], keys[i]) for i in range(1, m)]
        self.top = list(self.length)
        self.n, self.least = [1] * m, list(conv_ids)
        self.saved, self.kids = [0] * m, [0] * m
        # A leaf is counted at the last copy of a sequence that no longer one extends.
        self.leaves = [int(i == m - 1 or self.common[i + 1] < self.length[i]) for i in range(m)]
        self.first, self.last = list(range(m)), list(range(m))
        self.parent = [-1] * m
        self._joined = list(range(m))  # union-find over sequences
        self._place = list(range(m))  # the place of a set, by its root
        for i in sorted(range(1, m), key=lambda i: -self.common[i]):
            self._meet(i, self.common[i])
        root = self._place[self._root(0)]
        if self.top[root]:
            self.parent[root] = self._branch(0, root)
            self.kids[-1] = 1

    def _root(self, i: int) -> int:
        joined = self._joined
        while joined[i] != i:
            joined[i] = joined[joined[i]]
            i = joined[i]
        return i

    def _branch(self, depth: int, like: int) -> int:
        """A new place at a depth with the members of ``like``."""
        for held in (self.n, self.least, self.saved, self.leaves, self.first, self.last):
            held.append(held[like])
        self.top.append(depth)
        self.kids.append(0)
        self.parent.append(-1)
        return len(self.top) - 1

    def _meet(self, i: int, depth: int) -> None:
        """Joins the set that ends with sequence i - 1 and the one that starts with i."""
        ra, rb = self._root(i - 1), self._root(i)
        a, b = self._place[ra], self._place[rb]
        both = (self.n[a] + self.n[b], min(self.least[a], self.least[b]),
                self.saved[a] + self.saved[b] + int(self.upto[i][depth]), self.leaves[a] + self.leaves[b],
                self.first[a], self.last[b])
        deeper = [x for x in (a, b) if self.top[x] > depth]
        if len(deeper) == 2:
            c = self._branch(depth, a)
        else:
            c = b if self.top[a] > depth else a
        if not deeper:
            self.kids[a] += self.kids[b]
            self._absorbed(b, a)
        for x in deeper:
            self.parent[x] = c
            self.kids[c] += 1
        (self.n[c], self.least[c], self.saved[c], self.leaves[c], self.first[c], self.last[c]) = both
        self._joined[rb] = ra
        self._place[ra] = c

    def _absorbed(self, b: int, a: int) -> None:
        """Place b is the same node as a."""
        self.parent[b] = -2 - a

    def _above(self, x: int) -> int:
        """The place above x: what x hangs on may have been absorbed by another place."""
        p = self.parent[x]
        while p >= 0 and self.parent[p] <= -2:
            p = -2 - self.parent[p]
        return p

    def rows(self, block: int) -> Iterator[tuple]:
        m = len(self.keys)
        left = digests(self.keys[0], self.length[0])
        right = digests(self.keys[-1], self.length[-1])
        yield (EDGE, None, None, None, None, None, None, None, None, None, None, block, self.keys[0],
               self.upto[0].astype("<i8").tobytes(), self.keys[-1])
        for x in range(len(self.top)):
            if self.parent[x] <= -2:
                continue
            p = self._above(x)
            low = self.top[p] + 1 if p >= 0 else 0
            top, n, least = self.top[x], self.n[x], self.least[x]
            upto = self.upto[self.first[x]]
            is_open = self.first[x] == 0 or self.last[x] == m - 1
            path = left if self.first[x] == 0 else right
            end = self.first[x]
            while end <= self.last[x] and self.length[end] == top:
                end += 1
            ids = ",".join(map(str, self.conv_ids[self.first[x]:end]))
            for d in range(low, top + 1):
                saved = self.saved[x] - (n - 1) * (int(upto[d - 1]) if d else 0)
                kids = self.kids[x] if d == top else 1
                if is_open:
                    yield (OPEN, path[d], path[d - 1] if d else None, least, d, None, n, kids, self.leaves[x], saved,
                           None, None, None, None, None)
                    continue
                above, held = (None, least) if d > low else (None, self.least[p])
                if d == low and (self.first[p] == 0 or self.last[p] == m - 1):
                    above, held = (left if self.first[p] == 0 else right)[d - 1], None
                ends = hashlib.sha256(ids.encode()).hexdigest() if d == top and ids else EMPTY
                yield (NODE, None, above, least, d, held, n, kids, self.leaves[x], saved, ends, None, None, None, None)
            if is_open and ids and low <= top:
                yield (ENDS, path[top], None, self.conv_ids[self.first[x]], top, None, None, None, None, None, ids,
                       None, None, None, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def _batches(rows: Iterator[tuple], size: int = 50_000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contracted forests of a sorted partition, block by block."""
    block = TaskContext.get().partitionId() << 32
    keys, conv_ids, words, turns = [], [], [], 0
    for b in batches:
        for key, conv_id, counts in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(),
                                        b.column("words"), strict=True):
            keys.append(key)
            conv_ids.append(conv_id)
            words.append(counts.values.to_numpy(zero_copy_only=False))
            turns += len(key) // KEY
            if len(keys) >= BLOCK_SEQUENCES or turns >= BLOCK_TURNS:
                yield from _batches(Forest(keys, conv_ids, words).rows(block))
                block, keys, conv_ids, words, turns = block + 1, [], [], [], 0
    if keys:
        yield from _batches(Forest(keys, conv_ids, words).rows(block))


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the block after a boundary took for new although the one before it has it."""
    def rows() -> Iterator[tuple]:
        for b in batches:
            for last, first, upto in zip(*(b.column(c).to_pylist() for c in ("last_key", "first_key", "first_words")),
                                         strict=True):
                common = common_turns(last, first)
                upto = np.frombuffer(upto, "<i8").tolist()
                path = digests(first, common)
                extended = int(common == len(last) // KEY)
                for d in range(common + 1):
                    yield (OPEN, path[d], path[d - 1] if d else None, None, d, None, 0, -int(d < common), -extended,
                           upto[common] - (upto[d - 1] if d else 0), None, None, None, None, None)

    yield from _batches(rows())


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its sorted parts, which pass by one after the other."""
    node, state, out = None, None, []
    for b in batches:
        for key, part in zip(b.column("node").to_pylist(), b.column("ends").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(part.encode())
            else:
                state.update(b"," + part.encode())
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["end_node", "digest"])
            out = []
    if node is not None:
        out.append((node, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["end_node", "digest"])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, turns): see the result's columns.

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, each node's members but one times
    the words of its last turn), ends_sha256 (of the ids of the members that end there, in
    order and comma-joined).  ``turns`` are structs as :func:`turn_sequences` gives them, null
    for none; conv_ids are distinct and not null.  A sequence without turns is a member of the
    root; equal sequences end at one node; without sequences there is no node.  A sequence is
    one row, 20 bytes a turn, and is handled in one block, however long.
    """
    spark = sequences.sparkSession
    scratch = Scratch(spark, "prefix-trie")
    turns = F.coalesce("turns", F.slice("turns", 1, 0))
    held = scratch(sequences.select(
        "conv_id", F.unhex(F.coalesce(F.array_join("turns.key", ""), F.lit(""))).alias("key"),
        F.coalesce(F.col("turns.words").cast("array<int>"), F.array().cast("array<int>")).alias("words")), "sequences")
    longest = held.agg(F.max(F.length("key"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges over whole keys and ids split equal sequences, too.  The sample that finds them
    # comes to the driver, so extremely long keys are ranged by their first turns.
    most = max(KEY * 64, SAMPLE_BYTES // (100 * parts) // KEY * KEY)
    by = ["key", "conv_id"] if longest <= most else [F.substring("key", 1, most)]
    pieces = scratch(held.repartitionByRange(*by).sortWithinPartitions("key", "conv_id")
                     .mapInArrow(_forests, _PIECES), "forests")

    edges = pieces.where(F.col("kind") == EDGE)
    blocks = sorted(r.block for r in edges.select("block").collect())  # one number per block
    opens = pieces.where(F.col("kind") == OPEN)
    if len(blocks) > 1:
        pairs = spark.createDataFrame(list(zip(blocks, blocks[1:])), "block long, next_block long")
        after = edges.select(F.col("block").alias("next_block"), "first_key", "first_words")
        meet = (pairs.join(edges.select("block", "last_key"), "block").join(after, "next_block")
                .select("last_key", "first_key", "first_words"))
        opens = opens.unionByName(meet.mapInArrow(_corrections, _PIECES))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    opens = scratch(opens.groupBy("node").agg(F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
                                              F.max("depth").alias("depth"), *sums), "open")
    ends = (pieces.where(F.col("kind") == ENDS).select("node", "conv_id", "ends")
            .repartition("node").sortWithinPartitions("node", "conv_id")
            .select("node", "ends").mapInArrow(_ends, "end_node binary, digest string"))
    opens_done = (opens.join(ends, opens["node"] == ends["end_node"], "left")
                  .withColumn("ends", F.coalesce("digest", F.lit(EMPTY))))

    closed = pieces.where(F.col("kind") == NODE)
    own = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    above = opens.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    hanging = (closed.where("parent IS NOT NULL").select("parent", *own)
               .unionByName(opens_done.where("parent IS NOT NULL").select("parent", *own))
               .join(above, F.col("parent") == F.col("above"), "left"))
    root = opens_done.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    nodes = [x.select("parent_conv_id", *own) for x in (closed.where("parent IS NULL"), hanging, root)]
    return reduce(DataFrame.unionByName, nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.col("ends").alias("ends_sha256"))
