import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import repeated
from tidemark.llm import repeats, substring_dedup, suffix_array_dedup
from tidemark.llm.substring_dedup import SuffixAutomaton, remove_repeated_words
from tidemark.llm.suffix_array_dedup import remove_repeated_bytes

SCHEMA = "doc_id long, text string, shard string, kept int"


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    words = [a + b for a in ("th", "on", "é", "ß", "x") for b in ("er", "ing", "a", "", "ñ")]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t", "\x1c", " "]) for _ in range(k))
    shared = [text(k) for k in (40, 70, 90, 200)]
    rows = []
    for i in range(n):
        parts = [text(rng.randrange(60)) for _ in range(rng.randrange(3))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts.insert(rng.randrange(len(parts) + 1), s[a:a + rng.randrange(len(s))])
        rows.append((rng.randrange(10 * n), "".join(parts)))
    rows = list({d: (d, t) for d, t in rows}.values())
    rows += [(100_000, None), (100_001, ""), (100_002, "a " * 300), (100_003, "a " * 200),
             (-5, "a " * 120), (None, shared[3]), (100_004, rows[0][1]), (100_005, text(3000))]
    rows += [rows[-1], rows[3]]
    return [(d, t, "x", 1) for d, t in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def expected(rows, width, split, join):
    rows = [(r[0], split((r[1] or "").encode())) for r in rows]
    out = []
    for (d, t), gone in zip(rows, repeated(rows, width), strict=True):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), join(x for x, g in zip(t, gone, strict=True) if not g), spans))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.n_tokens, r.n_removed, bytes(r.kept), len(r.starts)) for r in df.collect()], key=str)


@pytest.mark.parametrize("width", [8, 20, 50])
def test_words(spark, width):
    rows = corpus()
    assert result(remove_repeated_words(frame(spark, rows), width)) == expected(rows, width, bytes.split, b" ".join)


@pytest.mark.parametrize("width", [10, 50])
def test_bytes(spark, width):
    rows = corpus(4)
    assert result(remove_repeated_bytes(frame(spark, rows), width)) == expected(rows, width, list, bytes)


def test_carried_columns_and_empty_table(spark):
    df = frame(spark, corpus()).withColumn("ids", F.lit("i"))
    out = remove_repeated_bytes(df.drop("kept"), 50, ("shard", "ids"))
    assert out.where("shard = 'x' and ids = 'i'").count() == df.count()
    assert remove_repeated_words(df.where("false")).count() == 0


def test_automaton_against_search():
    rng = random.Random(1)
    held = [[rng.randrange(3) for _ in range(rng.randrange(25))] for _ in range(6)]
    automaton = SuffixAutomaton()
    for h in held:
        automaton.add(h)
    parts = {tuple(h[i:j]) for h in held for i in range(len(h)) for j in range(i, len(h) + 1)} | {()}
    text = [rng.randrange(4) for _ in range(80)]
    want = [max(k for k in range(i + 2) if tuple(text[i + 1 - k:i + 1]) in parts) for i in range(len(text))]
    assert automaton.matching_statistics(text) == want


def test_phrases_of_a_gram_are_told_apart_by_all_bits(monkeypatch):
    """Two phrases whose hashes differ in the lower half alone: neither is settled."""
    hashes = iter([1 << 40 | 1, 1 << 40 | 2])
    monkeypatch.setattr(repeats, "phrases", lambda *_: tuple(np.array([x], t) for x, t in (
        (7, "u8"), (next(hashes), "u8"), (0, "i8"), (3, "i8"))))
    ask = repeats._ask(substring_dedup.plan(), 5)
    parts = [b for d in (1, 2) for b in ask(iter([pa.RecordBatch.from_pydict(
        {"doc_id": [d], "mark": pa.array([d], pa.int32()), "text": ["a"]})]))]
    out = repeats._compare(substring_dedup.plan(), 5)(pa.Table.from_batches(parts))
    assert sorted(out["kind"].to_pylist()) == [2, 2]


def bounded(plan):
    """The plan with a ``settle`` that refuses more phrases of a gram than 1,000."""
    def settle(values, at, ids, grams):
        assert np.unique(grams, return_counts=True)[1].max() <= 1000
        return plan.settle(values, at, ids, grams)
    return replace(plan, settle=settle)


def test_a_passage_of_very_many_texts_is_not_one_tasks_work(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    rows = [(d, " ".join([*(word() for _ in range(15)), passage, *(word() for _ in range(15))]), "x", 1)
            for d in rng.sample(range(10_000), 1500)]
    rows += [rows[7]]
    out = repeats.remove_repeats(frame(spark, rows), bounded(substring_dedup.plan()))
    assert result(out) == expected(rows, 50, bytes.split, b" ".join)


@pytest.mark.parametrize("most", [0, 3])
def test_windows_of_crowded_grams(spark, most):
    rows = corpus(5)
    words, octets = (replace(p, most_open=most) for p in (substring_dedup.plan(20), suffix_array_dedup.plan(50)))
    assert result(repeats.remove_repeats(frame(spark, rows), words)) == expected(rows, 20, bytes.split, b" ".join)
    assert result(repeats.remove_repeats(frame(spark, rows), octets)) == expected(rows, 50, list, bytes)


@pytest.mark.parametrize("width", [300, 1000])
def test_wide_windows(spark, width):
    """Phrases of more than 255 windows."""
    rng = random.Random(width)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    shared = " ".join(word() for _ in range(1500))
    rows = [(d, " ".join([word() for _ in range(20 * d)] + [shared[d: 5000 - d]] + [word() for _ in range(9)]), "x", 1)
            for d in range(4)]
    assert result(remove_repeated_bytes(frame(spark, rows), width)) == expected(rows, width, list, bytes)
    assert result(remove_repeated_words(frame(spark, rows), width)) == expected(rows, width, bytes.split, b" ".join)
    with pytest.raises(ValueError, match="65535"):
        remove_repeated_bytes(frame(spark, rows), 70_000)


def test_carried_columns_of_any_name_and_one_id_on_many_rows(spark):
    names = ["kept", "starts", "ends", "n_removed", "n_tokens", "carried", "mark", "shard", "ids", "data", "a.b"]
    rng = random.Random(2)
    shared = " ".join(str(rng.random()) for _ in range(20))
    rows = [(7 if d % 3 else d, f"{d} {shared} {d}", "x", 1) for d in range(200)]
    df = frame(spark, rows).select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    out = remove_repeated_bytes(df, 50, tuple(names), within="row")
    assert result(out) == expected(rows, 50, list, bytes)
    assert {tuple(r.row) for r in out.select("row").collect()} == {tuple(names)}
    shards = df.withColumn("mark", F.hash("text")).select(repeats._text_shard_column(21).alias("s")).distinct().count()
    assert shards > 10
    told = df.withColumn("mark", F.hash("text")).select("doc_id", "mark", repeats._text_shard_column(21).alias("s"))
    for r in told.collect():
        assert repeats._text_shard(np.array([r.doc_id]), np.array([r.mark], np.int32), 21)[0] == r.s
    with pytest.raises(ValueError, match="kept"):
        remove_repeated_bytes(df, 50, ("kept",))
