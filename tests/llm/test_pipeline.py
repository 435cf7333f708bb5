"""Each stage against a plain version, on the input that the stage itself gets."""

import collections

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_line_dedup import brute as lines_left
from tests.llm.test_minhash import groups, shingled
from tidemark.sources.store import Scratch

DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch(stage(spark, out[-1], DIR), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert all(s.columns == COLUMNS for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "minhash_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_toxicity(spark, stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    assert all(d in after for d, y in labels.items() if not y)
    assert sum(d not in after for d, y in labels.items() if y) >= 0.5 * sum(labels.values())


def test_line_dedup(stages):
    before, after = texts(stages[1]), stages[2].collect()
    assert {r.doc_id: r.text for r in after} == dict(lines_left(sorted(before.items()), 10))
    assert all(r.n_chars == len(r.text) for r in after)


def test_minhash_dedup(stages):
    before = texts(stages[2])
    sets = {d: shingled(t, 5) for d, t in before.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    first = groups(list(sets), pairs)
    assert texts(stages[3]) == {d: t for d, t in before.items() if first[d] == d}


def test_suffix_array_dedup(stages):
    before, after = texts(stages[3]), stages[4].collect()
    held = {d: t.encode() for d, t in before.items()}
    seen: dict[bytes, int] = {}
    for d, b in held.items():
        for i in range(len(b) - 49):
            seen[b[i:i + 50]] = min(seen.get(b[i:i + 50], d), d)
    for r in after:
        t, gone = before[r.doc_id], set()
        b = held[r.doc_id]
        for i in range(len(b) - 49):
            if seen[b[i:i + 50]] < r.doc_id:
                gone.update(range(i, i + 50))
        at = np.cumsum([0] + [len(c.encode()) for c in t]).tolist()
        left = "".join(c for c, x, y in zip(t, at, at[1:], strict=False) if not gone & set(range(x, y)))
        assert (r.text, r.n_chars) == (left, len(left))


def test_packing(stages):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(tk.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(stages[4]).items()}
    got, bins = collections.Counter(), collections.Counter()
    for r in stages[5].collect():
        got[r.doc_id] += r.length
        bins[r.sequence_id] += r.length
    assert got == want and max(bins.values()) <= 4096


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns with the names that the operators use inside, null texts and ids, repeated rows."""
    names = ["toxic_score", "toxic_hits", "score", "n_lines", "n_removed_lines", "line_runs", "line_mark", "mark",
             "doc", "row", "flags", "gone_id", "component_id", "kept", "n_shingles", "starts", "ends", "n_removed",
             "n_tokens", "shard", "ids", "marks", "data", "carried_0", "first", "last", "a.b"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 40")
    odd = spark.createDataFrame([(None, "no id " * 30), (900, None), (901, ""), (902, "twice " * 30), (902, "twice " * 30)],
                                "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True).select("*", *[F.lit(n).alias(n) for n in names])
    docs = Scratch(spark, "odd")(docs, "docs")
    n, scratch = docs.count(), Scratch(spark, "odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == COLUMNS + names
        assert docs.select(*[f"`{c}`" for c in names]).distinct().collect() == [tuple(names)]
        assert n - 20 <= docs.count() <= n
        rows = {r.doc_id: r.text for r in docs.where("doc_id is null or doc_id in (900, 901)").collect()}
        assert rows[None] == "no id " * 30 and not rows[900] and rows[901] == ""
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert packed.where("doc_id in (900, 901)").agg({"length": "sum"}).first()[0] == 2
