"""Each registered query against a plain version of its contract."""

import collections
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from tests.llm.brute import repeated, sha
from tests.llm.test_embedding_dedup import brute as vector_links
from tests.llm.test_line_dedup import brute as lines_left
from tests.llm.test_minhash import groups, shingled
from tidemark.llm.queries import ORACLE_SQL, QUERIES

DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def rows(name):
    return pq.read_table(f"{DIR}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in rows("documents")]


def run(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, DIR).collect()]


def test_op1(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for d, t in docs:
        ids = sp.encode(t or "")
        want[d] = (len(ids), sha(",".join(map(str, ids)).encode()), sha(sp.decode(ids).encode()))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run(spark, "op1_sentencepiece")}
    assert got == want


def test_op2(spark):
    held = [(r["vec_id"], r["embedding"], r["label"]) for r in rows("embeddings")]
    nodes, pairs = vector_links(held)
    got = {r["vec_id"]: r for r in run(spark, "op2_embedding_dedup")}
    assert got.keys() == nodes
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * 2 * len(pairs)
    want = groups(nodes, pairs)
    assert sum(got[n]["component_id"] == want[n] for n in nodes) >= 0.98 * len(nodes)


def test_op3(spark, docs):
    sets = {d: shingled(t, 3) for d, t in docs}
    where = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    common = collections.Counter((a, b) for v in where.values() for a in v for b in v if a < b)
    pairs = [(a, b) for (a, b), n in common.items() if 100 * n >= 85 * len(sets[a] | sets[b])]
    want = groups(list(sets), pairs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in run(spark, "op3_minhash_dedup")}
    assert got == {d: (len(s), want[d], want[d] == d) for d, s in sets.items()}


def test_op4(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op4_quality_rules")}
    for d, t in docs:
        t = t or ""
        words = [w.decode() for w in t.encode().split()]
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        grams = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        inside = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        assert not (r["kept"] and r["base_failed"])
    good = [r["doc_id"] for r in rows("labels") if r["quality"] == 1]
    assert sum(got[d]["kept"] or got[d]["base_failed"] for d in good) == len(good)


def test_op5(spark, docs):
    want = {d: sha((t or "").encode()) for d, t in lines_left(sorted(docs), 10)}
    assert {r["doc_id"]: r["kept_sha256"] for r in run(spark, "op5_line_dedup")} == want


def test_op6(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op6_toxicity")}
    assert got.keys() == {d for d, _ in docs}
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)


def test_op6_on_held_out_rows(spark):
    found = {r["doc_id"]: r for r in (x.asDict() for x in QUERIES["op6_toxicity"](
        spark, "/root/testdata/sf0.1").select("doc_id", "held_out", "predicted").collect())}
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()
    told = [(r["toxic"], found[r["doc_id"]]["predicted"]) for r in labels if found[r["doc_id"]]["held_out"]]
    toxic, clean = [p for y, p in told if y], [p for y, p in told if not y]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_op7(spark, docs):
    from tokenizers import Tokenizer

    from tidemark.llm.packing import best_fit_plan

    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, lengths = set(), collections.Counter()
    for d, t in docs:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a:a + 4096]
            lengths[len(part)] += 1
            want.add((d, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = run(spark, "op7_best_fit_packing")
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert len(got) == len(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    plain = []
    for n in sorted(lengths.elements(), reverse=True):  # best fit, one piece at a time
        fits = [(4096 - used, i) for i, used in enumerate(plain) if used + n <= 4096]
        if fits:
            plain[min(fits)[1]] += n
        else:
            plain.append(n)
    assert len(bins) == len(plain)
    assert best_fit_plan({}) == []


def test_op8(spark, docs):
    held = [(d, (t or "").encode().split()) for d, t in docs]
    want = {d: (len(w), sum(g), sha(b" ".join(x for x, y in zip(w, g, strict=True) if not y)))
            for (d, w), g in zip(held, repeated(held, 50), strict=True)}
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
            for r in run(spark, "op8_substring_dedup")} == want


def test_op9(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{DIR}/pages.parquet')")
    cur = con.execute(ORACLE_SQL["op9_url_filters"])
    names = [c[0] for c in cur.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in cur.fetchall()), key=lambda r: r["page_id"])
    assert sorted(run(spark, "op9_url_filters"), key=lambda r: r["page_id"]) == want


def test_op10(spark, docs):
    held = [(d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, b in held:
        for i in range(len(b) - 49):
            k = b[i:i + 50]
            first[k] = min(first.get(k, d), d)
    want = {}
    for d, b in held:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < d:
                gone[i + 1:i + 51] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        want[d] = (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), sha(kept))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in run(spark, "op10_suffix_array_dedup")} == want
