import random
import re

from tidemark.llm.components import components
from tidemark.llm.minhash import near_duplicates


def groups(nodes, edges):
    at = {n: n for n in nodes}

    def find(n):
        while at[n] != n:
            n = at[n]
        return n
    for a, b in edges:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    nodes = list(range(400))
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)]
    edges += [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 400)] + [(7, 7)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    want = groups(nodes, edges)
    inside = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in components(df).collect()} == {n: want[n] for n in inside}
    assert components(df.where("false")).count() == 0


def shingled(text, size):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def test_near_duplicates(spark):
    rng = random.Random(2)
    words = [f"w{i}é" for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(20, 150))]
        for _ in range(rng.randrange(1, 40)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words).upper()
            rows.append(" ".join(copy))
    rows += [None, "", " \n", "one", "ONE", "one two", "É one", "é one", rows[0] + "\x85", "long " * 5000]
    rng.shuffle(rows)
    rows = [(i, t, 1) for i, t in enumerate(rows)]
    df = spark.createDataFrame([*rows, (None, rows[0][1], 1), rows[2]], "doc_id long, text string, n_shingles int")
    for size, percent in ((3, 85), (5, 80)):
        sets = {d: shingled(t, size) for d, t, _ in rows}
        pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
                 and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        want = groups(list(sets), pairs)
        out = near_duplicates(df, size, percent).collect()
        assert len(out) == len(rows) + 2
        for r in out:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.n_shingles, r.component_id, r.kept) == (
                    len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_duplicates(df.where("false")).count() == 0
