"""Collocations against a plain count, and against their SQL twin."""

import collections
import os
import random
import re

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import collocations as mining
from tidemark.llm.queries import ORACLE_SQL, QUERIES

DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, longest=3, least=10, percent=50, top=2000):
    """[(lang, text)] to the rows of the result."""
    lower = {c: c + 32 for c in range(65, 91)}
    f, total = collections.Counter(), collections.Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", *words[i:i + k]] += 1
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    contained = set()
    for g, n in candidates.items():
        for k in range(2, len(g) - 1):
            for i in range(1, len(g) - k + 1):
                inner = (g[0], *g[i:i + k])
                if 100 * n >= percent * f[inner]:
                    contained.add(inner)
    by_lang = collections.defaultdict(list)
    for g, a in candidates.items():
        if g not in contained:
            cuts = [(1000000 * a * a // (f[g[:1 + k]] * f[g[0], *g[1 + k:]]), k, f[g[:1 + k]], f[g[0], *g[1 + k:]])
                    for k in range(1, len(g) - 1)]
            score, _, left, right = min(cuts)
            by_lang[g[0]].append((-score, -a, " ".join(g[1:]).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, rows in by_lang.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def documents(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c", "Dd", "é", "e-f", "　g", "h i"]
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\t", ". ", ",\n", "  "])
             for _ in range(rng.randint(0, 25)))) for _ in range(n)]


def frame(spark, docs):
    rows = [(i, t, g, 1) for i, (g, t) in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long").repartition(3)


def test_op13(spark):
    docs = [(r["lang"], r["text"]) for r in pq.read_table(f"{DIR}/documents.parquet").to_pylist()]
    out = got(QUERIES["op13_collocations"](spark, DIR))
    assert out == brute(docs) and out
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DIR}/documents.parquet')")
    cur = con.execute(ORACLE_SQL["op13_collocations"])
    assert [c[0] for c in cur.description] == COLUMNS
    assert sorted(cur.fetchall()) == out


def test_columns_of_words_match_however_the_text_is_cut(monkeypatch):
    text = " ".join(f"w{i % 7}" + (". " if i % 11 == 0 else "") for i in range(400)).encode()
    whole = mining.Words([(np.frombuffer(text, np.uint8), len(text), 1)], 0)
    monkeypatch.setattr(mining, "CHUNK_BYTES", 40)
    for width in (1, 2, 3):
        parts = []
        for b, until in mining.blocks(np.frombuffer(text, np.uint8), width):
            w = mining.Words([(b, until, 1)], 0)
            at = np.flatnonzero(w.starts(width) & w.emits)
            parts.append(np.stack(w.columns(at, width)))
        at = np.flatnonzero(whole.starts(width))
        assert (np.concatenate(parts, axis=1) == np.stack(whole.columns(at, width))).all()
    giant = np.frombuffer(b"x" * 500 + b" y " + b"z" * 300, np.uint8)
    assert sum(int((w.emits & w.starts(1)).sum()) for b, u in mining.blocks(giant, 1)
               for w in [mining.Words([(b, u, 1)], 0)]) == 3


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equal_partitions(least):
    rng = np.random.default_rng(least)
    columns = [rng.integers(0, 6, 3000).astype(np.uint64) for _ in range(3)]
    weight = rng.integers(1, 4, 3000)
    at, total = mining.equal_partitions(columns, weight, least)
    want = collections.Counter()
    for row, w in zip(zip(*[c.tolist() for c in columns]), weight.tolist()):
        want[row] += w
    rows = list(zip(*[c[at].tolist() for c in columns]))
    assert dict(zip(rows, total.tolist(), strict=True)) == {r: w for r, w in want.items() if w >= least}
    none = np.zeros(0, np.uint64)
    assert len(mining.equal_partitions([none, none], none, 1)[0]) == 0


def test_entries_keep_all_counts():
    rng = np.random.default_rng(5)
    columns = [rng.integers(0, 9, 5000).astype(np.uint64) for _ in range(2)]
    found = collections.Counter()
    for _, n, data in mining.entries(columns, 7):
        (a, b), count = mining.counted(iter([(n, data)]), 2)
        for x, y, c in zip(a.tolist(), b.tolist(), count.tolist()):
            found[x, y] += c
    assert found == collections.Counter(zip(columns[0].tolist(), columns[1].tolist()))


@pytest.mark.parametrize("longest, top", [(2, 2000), (3, 5), (4, 2000)])
def test_small_flushes_and_blocks(spark, monkeypatch, longest, top):
    monkeypatch.setattr(mining, "FLUSH", 50)
    monkeypatch.setattr(mining, "CHUNK_BYTES", 64)
    docs = documents(longest)
    assert got(mining.collocations(frame(spark, docs), max_words=longest, top=top)) == brute(docs, longest, top=top)


def test_edges(spark):
    """Nulls, empty and long texts, repeated rows, ties, a hot pair, clashing columns, empty tables."""
    docs = [(None, None), ("en", ""), ("en", " \t."), (None, "p q " * 40), ("und", "q p " * 9), ("x", "u v. " * 9)]
    docs += [("fr", "Hot pair")] * 400 + [("fr", f"hot pair w{i}") for i in range(30)]
    docs += [("de", "ein wort. " * 20_000 + "a" * 3_000_000 + " zwei drei" * 10)]
    docs += [("t", f"b{i} c{i}; d{i} e{i}") for i in range(6)] * 10
    df = frame(spark, docs).selectExpr("*", "'x' AS word", "1 AS h", "2 AS score", "3 AS c0")
    out = got(mining.collocations(df))
    assert out == brute(docs)
    assert ("fr", 1, "hot pair", 430, 430, 430, 890, 1000000) in out
    assert got(mining.collocations(df, top=4)) == brute(docs, top=4)  # ties at the last place
    assert mining.collocations(df.where("false")).count() == 0


def test_words_that_share_a_hash_take_another_salt(spark, monkeypatch):
    from tidemark.sources.store import Scratch

    salts = []
    real = mining._word_counts
    def forged(salt):
        salts.append(salt)
        if salt:
            return real(salt)
        def run(batches):
            for _ in batches:
                pass
            import pyarrow as pa
            yield pa.RecordBatch.from_arrays([pa.array([1, 1]), pa.array(["en", "en"]), pa.array(["x", "y"]),
                                              pa.array([4, 4])], ["h", "lang", "word", "n"])
        return run
    monkeypatch.setattr(mining, "_word_counts", forged)
    docs = frame(spark, documents(1)).selectExpr("coalesce(lang, 'und') AS lang", "text")
    table, salt = mining.word_counts(docs, 10, Scratch(spark, "salts"))
    assert salt == 1 and salts == [0, 1] and table.count() > 3
