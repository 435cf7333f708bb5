"""The verdict of the quality rules and the toxicity score against plain versions."""

import collections
import math
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules, toxicity
from tidemark.llm.queries import QUERIES

DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{DIR}/documents.parquet").to_pylist()


def char_class(c):
    for k, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ",
                                 "\t\n\r\x0b\x0c", ".!?", ",;:", "#*$%&|<>"), 1):
        if c in members:
            return k
    if c < " " or c == "\x7f":
        return 12
    if c < "\x7f":
        return 9
    return 10 if "À" <= c <= "ÿ" else 11


def distance(counts, reference):
    """Jensen-Shannon distance of two counters, by its definition in bits."""
    n, m = sum(counts.values()), sum(reference.values())
    if not n:
        return 0.0
    total = 0.0
    for k in {*counts, *reference}:
        p, q = counts[k] / n, reference[k] / m
        for x in (p, q):
            total += x * math.log2(2 * x / (p + q)) / 2 if x else 0
    return math.sqrt(max(total, 0))


def test_quality_verdict(spark, docs):
    listed = {w for line in quality_rules.COMMON_WORDS for w in line.split()}
    lower = {c: c + 32 for c in range(65, 91)}
    got = {r.doc_id: r for r in quality_rules.judge(spark.read.parquet(f"{DIR}/documents.parquet")).collect()}
    chars, words = {}, {}
    sums = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for r in docs:
        text = r["text"] or ""
        chars[r["doc_id"]] = collections.Counter(map(char_class, text))
        words[r["doc_id"]] = collections.Counter(
            w if (w := x.decode()) in listed else None for x in text.translate(lower).encode().split())
        if not got[r["doc_id"]].base_failed:
            sums[0][r["lang"]].update(chars[r["doc_id"]])
            sums[1][r["lang"]].update(words[r["doc_id"]])
    rejected = 0
    for r in docs:
        g, n = got[r["doc_id"]], got[r["doc_id"]].n_words
        found = distance(chars[r["doc_id"]], sums[0][r["lang"]]), distance(words[r["doc_id"]], sums[1][r["lang"]])
        assert (g.char_distance, g.word_distance) == pytest.approx(found, abs=1e-9)
        far = n >= 60 and (found[0] > 0.16 + 1.2 / n ** 0.5 or found[1] > 0.1 + 2.8 / n ** 0.5)
        assert g.kept == (not g.base_failed and not far)
        rejected += far and not g.base_failed
    assert rejected


def places(text, part):
    return [i for i in range(len(text)) if text.startswith(part, i)]


def test_toxicity_score(spark, docs):
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    table = spark.read.parquet(f"{DIR}/documents.parquet")
    lexicon = toxicity.learn(table, spark.read.parquet(f"{DIR}/labels.parquet").where(~held_out))
    got = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, DIR).collect()}
    hits = 0
    for r in docs:
        text = toxicity.fold(r["text"] or "")
        spared = set()
        for e in lexicon.exceptions:
            if e not in lexicon.terms:
                spared.update(i + k for i in places(text, e) for k in range(len(e)))
        z, n = lexicon.bias, 0
        for t, w in zip(lexicon.terms, lexicon.weights, strict=True):
            found = sum(not spared.issuperset(range(i, i + len(t))) for i in places(text, t))
            n += found
            z += w * math.log(1 + found * 1000 / max(len(text), 200))
        assert got[r["doc_id"]].toxic_hits == n
        assert got[r["doc_id"]].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)
        hits += n
    assert hits and lexicon.terms


def test_columns_of_any_name_stay(spark):
    """The pipeline's toxicity stage changes no column, also not one named as a score."""
    lexicon = toxicity.Lexicon(("bad",), (9.0,), (), -3.0)
    df = spark.createDataFrame([(1, "bad bad", "a", 2), (2, None, "b", 3)],
                               "doc_id long, text string, toxic_score string, toxic_hits int")
    told = df.where(toxicity.scorer(lexicon)(F.col("text"))["score"] < 0.5)
    assert [tuple(r) for r in told.collect()] == [(2, None, "b", 3)]
    assert toxicity.score(df, lexicon).columns == df.columns
