import pyarrow.parquet as pq

from tidemark.llm.quality_rules import GUARD_WORDS, judge

DIR = "/root/testdata/sf0.1"


def test_labelled_junk_is_found(spark):
    got = {r.doc_id: r for r in judge(spark.read.parquet(f"{DIR}/documents.parquet")).collect()}
    judged = [(r["quality"], got[r["doc_id"]]) for r in pq.read_table(f"{DIR}/labels.parquet").to_pylist()]
    judged = [(y, r) for y, r in judged if not r.base_failed and r.n_words >= GUARD_WORDS]
    junk, good = [r for y, r in judged if y == 0], [r for y, r in judged if y == 1]
    assert sum(not r.kept for r in junk) >= 0.83 * len(junk) > 0
    assert sum(not r.kept for r in junk if r.n_words >= 200) >= 0.98 * sum(r.n_words >= 200 for r in junk)
    assert sum(r.kept for r in good) >= 0.998 * len(good) > 0
