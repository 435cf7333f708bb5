import math
import random

import numpy as np

from tests.llm.test_minhash import groups
from tidemark.llm.embedding_dedup import COSINE, near_duplicate_vectors


def brute(rows):
    unit = {}
    for k, v, label in rows:
        if k is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        u = np.array(v, float) / np.abs(v).max()
        unit[k] = (label, u / np.linalg.norm(u))
    pairs = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0]
             and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= COSINE]
    return {k for k, *_ in rows}, pairs


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 12)):
            rows.append([float(x) for x in base + rng.normal(size=16) * rng.choice([0, 0.1, 0.25])])
    rows = [(v, int(rng.integers(3))) for v in rows]
    rows += [(rows[0][0], rows[0][1])] * 40 + [([2 * x for x in rows[0][0]], rows[0][1])]
    rows += [(None, 1), ([0.0] * 16, 1), ([1.0, None] * 8, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1),
             ([], 1), ([1.0, 2.0], 1), ([1.0, 2.0], 1), (rows[0][0], None), ([1e300] * 16, 2), ([1e-300] * 16, 2)]
    random.Random(1).shuffle(rows)
    rows = [(i, v, label) for i, (v, label) in enumerate(rows)]
    df = spark.createDataFrame([*rows, rows[5], (None, rows[0][1], 1)], "vec_id long, embedding array<double>, label int")
    out = near_duplicate_vectors(df.repartition(4)).collect()
    nodes, pairs = brute(rows)
    assert len(out) == len(rows) + 2
    links = {n: 0 for n in nodes}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    got = {r.vec_id: r for r in out if r.vec_id is not None}
    assert all(got[n].n_links <= links[n] for n in nodes)
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(links.values()) > 0
    want = groups(nodes, pairs)
    assert sum(got[n].component_id == want[n] for n in nodes) >= 0.97 * len(nodes)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert near_duplicate_vectors(df.where("false")).count() == 0


def test_a_third_of_all_rows_are_perturbed_copies(spark):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    copies = unit(rng.normal(size=64)) + rng.normal(size=(1000, 64)) * (1 / 0.94 - 1) ** 0.5 / 8
    held = unit(rng.permutation(np.vstack([copies, rng.normal(size=(2000, 64))])))
    near = held @ held.T >= COSINE
    links = near.sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(held)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in near_duplicate_vectors(df.repartition(4)).collect()}
    assert all(got[i] <= links[i] for i in got)
    assert sum(got.values()) >= 0.98 * links.sum() > 0
