"""The prefix trie against a plain trie, and against its SQL twin."""

import collections
import hashlib
import os
import random
import zlib

import duckdb
import pyarrow.parquet as pq
import pytest

from tidemark.llm import prefix_trie as trie
from tidemark.llm.queries import ORACLE_SQL, QUERIES

DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def brute(sequences):
    """{conv_id: [(role, text), ...]} to the rows of the trie."""
    members = collections.defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, rows = collections.Counter(), []
    leaves, saved = collections.Counter(), collections.Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, held in members.items():
        own = (len(held) - 1) * len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += node not in kids
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(sequences[c]) == len(node))
        rows.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), kids[node],
                     leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rebuilt(rows):
    own = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["turn"] is not None, r["turn"] or 0)):
        own[r["conv_id"]].append((r["role"] or "", r["text"] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def got(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               "ends_sha256"]
    assert df.columns == columns
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, sequences):
    rows = [(c, i, r, t, "x") for c, turns in sequences.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")


def test_op12(spark):
    rows = pq.read_table(f"{DIR}/conversations.parquet").to_pylist()
    out = got(QUERIES["op12_prefix_trie"](spark, DIR))
    assert out == brute(rebuilt(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{DIR}/conversations.parquet')")
    assert sorted(con.execute(ORACLE_SQL["op12_prefix_trie"]).fetchall(), key=str) == out


@pytest.mark.parametrize("block, parts", [(1, 3), (2, 2), (3, 7), (5, 1), (1000, 4)])
def test_blocks_and_partitions_do_not_matter(spark, monkeypatch, block, parts):
    """Prefixes and copies that reach over many blocks, and sequences that end inside others."""
    monkeypatch.setattr(trie, "BLOCK_SEQUENCES", block)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rng = random.Random(block)
    sequences = {c: [("u", rng.choice(["a b", "c", "d e f"])) for _ in range(rng.randint(1, 5))] for c in range(60)}
    sequences |= {c: sequences[0][:3] + [("a", "x y")] * 2 for c in range(100, 140)}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        plain = trie.turn_sequences(frame(spark, sequences)).select("conv_id", "turns")
        assert got(trie.prefix_trie(plain)) == brute(sequences)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_random_forests():
    rng = random.Random(7)
    for _ in range(200):
        m = rng.randint(1, 12)
        texts = sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(m))
        import numpy as np

        forest = trie.Forest([b"".join(t.encode() * trie.KEY for t in x) for x in texts], list(range(m)),
                             [np.array([ord(t) - 90 for t in x], dtype=np.int64) for x in texts])
        rows = [r for r in forest.rows(0) if r[0] in (trie.NODE, trie.OPEN)]
        nodes = {x[:d] for x in texts for d in range(len(x) + 1)}
        assert len(rows) == len(nodes)
        want = collections.Counter()
        for node in nodes:
            n = sum(x.startswith(node) for x in texts)
            below = [b for b in nodes if b.startswith(node)]
            saved = sum((sum(x.startswith(b) for x in texts) - 1) * (ord(b[-1]) - 90) for b in below if b)
            leaves = sum(not any(c.startswith(b) and c != b for c in nodes) for b in below)
            want[len(node), n, sum(len(c) == len(node) + 1 for c in below), leaves, saved] += 1
        assert collections.Counter((r[4], r[6], r[7], r[8], r[9]) for r in rows) == want


def test_edges(spark, monkeypatch):
    """Null turns, roles, texts and ids, repeated and turnless rows, one long conversation, extra columns."""
    rows = [(5, None, "u", "first"), (5, 1, None, "x"), (5, 2, "u", None), (7, 1, "u", "x"), (7, 1, "u", "x"),
            (None, 1, "u", "lost"), (21, 0, "u", "gone"), (40, 0, "", ""), (41, 0, None, None)]
    rows += [(60, i, "u", "same words here") for i in range(150)]
    rows += [(61, i, "u", "same words here") for i in range(149)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS depth", "'k' AS key", "2 AS base")
    plain = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            plain[c].append((r or "", x or ""))
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in plain}
    want = {c: plain.get(c - c % 20, [])[:heads[c]] + t[heads[c]:] for c, t in plain.items()}
    from pyspark.sql import functions as F

    sequences = trie.turn_sequences(df)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    assert [] in want.values()
    out = got(trie.prefix_trie(trie.with_shared_heads(sequences, h)))
    assert out == brute(want)
    monkeypatch.setattr(trie, "SAMPLE_BYTES", 0)  # ranges by the first turns only
    assert got(trie.prefix_trie(trie.with_shared_heads(sequences, h))) == out
    assert trie.prefix_trie(trie.turn_sequences(df.where("false")).select("conv_id", "turns")).count() == 0
