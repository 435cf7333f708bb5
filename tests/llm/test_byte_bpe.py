"""Byte-level BPE against the tiktoken library, and the perfect hash against a dictionary."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe
from tidemark.llm.perfect_hash import PerfectHash, Spans
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.Ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks,
                             special_tokens={})


def as_bytes(text):
    return np.frombuffer(text.encode(), np.uint8)


def test_perfect_hash_is_minimal_and_exact(ranks):
    keys = list(ranks.ranks)
    table = ranks.table
    assert sorted(table.key.tolist()) == list(range(len(keys)))
    probes = keys[::7] + [k + b"\x00" for k in keys[::11]] + [k[:-1] for k in keys[::13] if len(k) > 1] + [b"q" * 99]
    lengths = np.array([len(p) for p in probes])
    spans = Spans(np.frombuffer(b"".join(probes), np.uint8), np.cumsum(lengths) - lengths, lengths)
    place = {k: i for i, k in enumerate(keys)}
    assert table.find(spans).tolist() == [place.get(p, -1) for p in probes]


@pytest.mark.parametrize("keys", [[], [b"a"], [b"a", b"b", b"ab", b"abcdefgh", b"abcdefghi"]])
def test_small_perfect_hashes(keys):
    table = PerfectHash(keys)
    probes = [*keys, b"zz"]
    lengths = np.array([len(p) for p in probes])
    spans = Spans(np.frombuffer(b"".join(probes), np.uint8), np.cumsum(lengths) - lengths, lengths)
    assert table.find(spans).tolist() == [*range(len(keys)), -1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" '  \n\tsstmdrevl'a1!　\xa0"), st.characters(
    exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=6))
def test_encodes_as_the_library(ranks, library, texts):
    ids = ranks.encode([as_bytes(t) for t in texts])
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert [ranks.decode(x) for x in ids] == [t.encode() for t in texts]


def test_every_code_point_has_the_library_class(ranks, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f"x{chr(c)}1{chr(c)}!{chr(c)}  {chr(c)}" for c in points]
    ids = ranks.encode([as_bytes(t) for t in texts])
    assert all(x.tolist() == library.encode_ordinary(t) for x, t in zip(ids, texts, strict=True))


def test_long_words_and_blocks(ranks, library, monkeypatch):
    word = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(30_000))
    assert ranks.encode([as_bytes(word)])[0].tolist() == library.encode_ordinary(word)
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 40)
    texts = ["a  b 's don't\n\n x " * 50, "x" * 500, " " * 300, "é " * 100, "", "end. " * 30 + "\n\n"]
    for t in texts:
        parts = byte_bpe.blocks(as_bytes(t))
        assert b"".join(p.tobytes() for p in parts) == t.encode()
        assert np.concatenate([ranks.encode([p])[0] for p in parts]).tolist() == library.encode_ordinary(t)


def test_edges(spark, library):
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (3, "word's " * 9000, 5), (3, "word's " * 9000, 5),
            (4, " \t\n<|endoftext|> é\x00", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = byte_bpe.encode_and_decode(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got) == sorted(
        (d or 0, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode())
        for d, t, _ in rows for ids in [library.encode_ordinary(t or "")])
    encoded = byte_bpe.encode(df, PATH)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    back = byte_bpe.decode(encoded, PATH).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in back) == sorted(
        (d or 0, (t or "").encode()) for d, t, _ in rows)
    assert byte_bpe.encode_and_decode(df.where("false"), PATH).count() == 0


def test_op11(spark, library):
    want = {}
    for r in pq.read_table(f"{DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in QUERIES["op11_byte_bpe"](spark, DIR).collect()}
    assert got == want
