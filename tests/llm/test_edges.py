"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import public_tokenizers

from tidemark.llm import toxicity
from tidemark.llm.packing import pack
from tidemark.llm.quality_rules import judge
from tidemark.llm.sentencepiece_bpe import encode_and_decode


def test_edges(spark):
    rows = [(1, None, None, 5), (2, "", "en", 5), (None, "a b", "en", 5), (3, "word " * 9000, "en", 5),
            (3, "word " * 9000, "en", 5), (4, " \t\n▁<s> é\x00", "xx", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, piece int")
    ids = {r.doc_id: r for r in encode_and_decode(df, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert ids[1].n_tokens == ids[2].n_tokens == 0 and ids[1].ids == "" and None in ids
    packed = pack(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in packed if r.doc_id in (1, 2)) == 2
    assert sum(r.length for r in packed if r.doc_id == 3) == 2 * 9001
    judged = judge(df).collect()
    assert len(judged) == len(rows) and all(not r.kept for r in judged)
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, toxic int")
    lexicon = toxicity.learn(df, labels)
    scored = toxicity.score(df, lexicon).collect()
    assert len(scored) == len(rows) and all(0 <= r.toxic_score <= 1 for r in scored)
    none = df.where("false")
    assert [f.count() for f in (encode_and_decode(none, public_tokenizers.path("piece_bpe_32k.model")),
                                pack(none, public_tokenizers.path("word_bpe_49k.json")), judge(none),
                                toxicity.score(none, lexicon))] == [0] * 4
