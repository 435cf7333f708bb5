import collections
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm.line_dedup import remove_repeated_lines


def brute(rows, min_words):
    """rows: (doc_id, text); what is left of each text.

    Every run of lines with ``min_words`` words that starts at an earlier place goes whole; a
    line without a word goes if the lines with words around it do.
    """
    texts, places = [], collections.defaultdict(list)
    for r, (d, t) in enumerate(rows):
        held = [(i, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate((t or "").split("\n"))]
        texts.append([h for h in held if h[2]] if d is not None and t is not None else [])
        for s, (_, x, _) in enumerate(texts[-1]):
            places[x].append((d, s, r))
    gone = set()
    for r, held in enumerate(texts):
        for s, (_, x, _) in enumerate(held):
            longest = 0  # lines from here on that an earlier place holds, too
            for d, z, o in places[x]:
                if (d, z) < (rows[r][0], s):
                    n = 0
                    while z + n < len(texts[o]) and s + n < len(held) and texts[o][z + n][1] == held[s + n][1]:
                        n += 1
                    longest = max(longest, n)
            run = held[s:s + longest]
            if sum(w for _, _, w in run) >= min_words:
                gone.update((r, i) for i, _, _ in run)
        for (a, _, _), (b, _, _) in zip(held, held[1:]):
            if {(r, a), (r, b)} <= gone:
                gone.update((r, i) for i in range(a, b))
    return [(d, t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (r, i) not in gone))
            for r, (d, t) in enumerate(rows)]


@pytest.mark.parametrize("min_words", [1, 3, 10])
def test_lines(spark, min_words):
    rng = random.Random(min_words)
    stock = [" ".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6))) for _ in range(25)] + ["", " \t", "x " * 12]
    rows = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randrange(12)))) for i in range(150)]
    rows += [(i, "\n".join([f"own {i}", *stock[:9], f"end {i}"])) for i in range(150, 170)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, rows[160][1]), (203, "same line here\n" * 300)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, n_lines int")
    out = remove_repeated_lines(df.repartition(5), min_words).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(brute(rows, min_words), key=str)
    assert all(r.source == "s" for r in out)
    assert remove_repeated_lines(df.where("false"), min_words).count() == 0


def test_tails_of_a_run_go_with_it(spark):
    """Shared lines of 12, 3 and 4 words: all three are one repeated run."""
    shared = "\n".join(" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 12), ("b", 3), ("c", 4)))
    rows = [(1, "own one\n" + shared), (2, shared + "\nown two"), (3, shared), (4, shared.split("\n", 1)[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in remove_repeated_lines(df).collect()}
    assert left == {1: rows[0][1], 2: "own two", 3: "", 4: rows[3][1]}


def test_columns_of_any_name_are_passed_through(spark):
    names = ["doc", "mark", "row", "flags", "removed", "line_runs", "line_mark", "first", "last", "n_lines", "name",
             "needs", "pos", "runs", "a.b"]
    df = spark.createDataFrame([(1, "x " * 12), (2, "x " * 12 + "\ny")], "doc_id long, text string")
    df = df.select("*", *[F.lit(n).alias(n) for n in names])
    out = remove_repeated_lines(df, counts=False)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x " * 12, *names), (2, "y", *names)]
    counted = remove_repeated_lines(df.drop("a.b"))
    assert counted.columns == [c for c in df.columns if c not in ("n_lines", "a.b")] + ["n_lines", "n_removed_lines"]


def test_very_many_short_lines(spark):
    text = "\n".join(f"line {i % 150_000}" for i in range(300_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    row = remove_repeated_lines(df).first()
    assert (row.n_lines, row.n_removed_lines) == (300_000, 150_000)
    assert time.time() - start < 120
